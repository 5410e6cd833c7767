import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, times int, row int, arc int, size int"

#: Nulls in every column, empty and blank texts, equal texts in other cases, repeated rows, repeated ids.
ODD = [
    (1, "Alpha beta gamma delta epsilon", "en", "a"),
    (2, "alpha BETA gamma delta epsilon", "en", "b"),
    (3, "alpha beta gamma delta epsilon!", "en", None),
    (3, "alpha beta gamma delta epsilon!", "en", None),
    (4, None, None, None),
    (5, "", "de", "a"),
    (6, " \n\t ", "de", "b"),
    (None, "alpha beta gamma delta epsilon", None, "c"),
    (None, "only here", "fr", "c"),
    (7, "É one two three", "fr", "c"),
    (8, "é one two three", "fr", "c"),
    (9, "word " * 30_000, "en", "b"),
    (9, "other text of the same id", "en", "b"),
    (9, "other text of the same id", "es", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, la, s, None if t is None else len(t), "x", 1, 2, 3, 4) for i, t, la, s in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


#: Names that the stages use inside, as further columns of the documents.
INNER = "passes upto of_source times drop_key drop_tag tag at at_range heavy lies range inside before order_key tie size target taken keep component fingerprint share rank span".split()


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with a column of every name that a stage uses inside."""
    return odd.selectExpr(*odd.columns, *(f"'{c}' AS {c}" for c in INNER if c not in odd.columns))
