import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from windrow.functions.text import explode_lines, explode_words, line_word_counts

TOKENS = [
    ("", [""]),
    (" ", []),
    ("123", []),
    (" abc", ["", "abc"]),
    ("abc ", ["abc"]),
    ("12 a b  ", ["", "a", "b"]),
    ("éa", ["", "a"]),
    ("A a", ["A", "a"]),
    ("a\tb\r", ["a", "b"]),
    ("x😀y", ["x", "y"]),
    ("a a b a", ["a", "a", "b", "a"]),
]


@pytest.mark.parametrize("line, words", TOKENS)
@pytest.mark.parametrize("drop_empty", [False, True])
def test_words(spark, line, words, drop_empty):
    df = spark.createDataFrame([(1, line)], "id int, line string")
    want = [w for w in words if w or not drop_empty]
    assert sorted(r.word for r in explode_words(df, drop_empty=drop_empty).collect()) == sorted(want)
    counts = {r.word: r.n for r in line_word_counts(df, drop_empty=drop_empty).collect()}
    assert counts == {w: want.count(w) for w in want}


@pytest.mark.parametrize(
    "text, want",
    [
        ("x\ny\n", ["x", "y"]),
        ("x\r\ny", ["x", "y"]),
        ("", []),
        ("\n", [""]),
        ("x\n\ny", ["x", "", "y"]),
        ("x\n\n", ["x", ""]),
        ("x\r\r\ny\r", ["x\r", "y\r"]),
        ("\r\n", [""]),
    ],
)
def test_lines(spark, text, want):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    assert [r.line for r in explode_lines(df).orderBy("pos").collect()] == want


def test_line_counts_need_no_shuffle(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    counted = line_word_counts(explode_lines(docs))
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


def test_long_line_is_counted_whole(spark):
    df = spark.createDataFrame([(1, "ab cd " * 50_000)], "id int, line string")
    assert rows(line_word_counts(df), "word") == [(1, "ab", 50_000), (1, "cd", 50_000)]


def plain_words(line):
    """The rule spelled out: blank what is no letter, split at white space, drop empties at the end."""
    parts = re.split(r"\s+", re.sub("[^a-zA-Z ]", " ", line))
    if parts == [""]:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("aZ b1.\té😀 ", max_size=12), min_size=1, max_size=60))
def test_any_line(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, line string")
    want = Counter((i, w) for i, t in enumerate(texts) for w in plain_words(t))
    assert Counter((r.id, r.word) for r in explode_words(df).collect()) == want
    assert {(r.id, r.word): r.n for r in line_word_counts(df).collect()} == dict(want)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("a\r\n", max_size=8), min_size=1, max_size=60))
def test_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = []
    for i, text in enumerate(texts):
        *ended, last = text.split("\n")
        found = [line.removesuffix("\r") for line in ended] + ([last] if last else [])
        want += [(i, pos, line) for pos, line in enumerate(found)]
    assert rows(explode_lines(df), "id", "pos") == want


def test_null_text_and_line(spark):
    df = spark.createDataFrame([(1, None)], "id int, text string")
    assert explode_lines(df).collect() == []
    lines = df.withColumnRenamed("text", "line")
    assert explode_words(lines).collect() == []
    assert line_word_counts(lines).collect() == []


@pytest.mark.parametrize("line, want", [("x\r", "x"), ("x\r\r", "x\r"), ("x\r\u0085", "x\r\u0085"), ("x\r\u2028", "x\r\u2028"), ("\r", "")])
def test_line_ends_of_files_and_texts_agree(spark, tmp_path, line, want):
    (tmp_path / "a.txt").write_bytes(f"{line}\nlast".encode())
    raw = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert raw.select(F.regexp_replace("value", r"\r\z", "")).first()[0] == want
    texts = spark.createDataFrame([(f"{line}\nlast",)], "text string")
    assert explode_lines(texts).orderBy("pos").first().line == want
