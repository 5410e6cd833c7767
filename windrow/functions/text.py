"""Lines and words of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line: ``pos`` (from 0) and ``line`` in place of the text column.

    ``\\n`` ends a line (a ``\\r`` before it goes too); nothing after the last ``\\n`` is no line.
    """
    rest = [c for c in df.columns if c != text]
    parts = df.select(*rest, F.split(text, "\n").alias("_parts"))
    sized = parts.withColumn("_size", F.size("_parts"))
    # The outer form adds no rows here (a split is never empty) and keeps Catalyst from testing the
    # split for emptiness first, which would run it twice; a null text is dropped below.
    cut = sized.select(*rest, "_size", F.posexplode_outer("_parts").alias("pos", "line"))
    ended = F.col("pos") < F.col("_size") - 1
    kept = cut.where(ended | (F.col("line") != ""))
    bare = F.when(ended & F.col("line").endswith("\r"), F.expr("left(line, length(line) - 1)"))
    return kept.select(*rest, "pos", F.coalesce(bare, "line").alias("line"))


def explode_words(df: DataFrame, line: str = "line", drop_empty: bool = False) -> DataFrame:
    """One row per word of each line, in a column ``word`` that replaces the line.

    Words are runs of ASCII letters, case kept; everything else separates.  Classic split rules
    make an empty word out of an empty line and out of separators before the first word; pass
    ``drop_empty`` to leave those out.
    """
    rest = [c for c in df.columns if c != line]
    if drop_empty:
        return df.select(*rest, F.explode(_split(line)).alias("word")).where("word <> ''")
    # Only the first and the last token can be empty; the first is a word unless the line has
    # separators alone.  Found per line, so that the words need not carry the line along.
    leads = (F.col(line) == "") | F.col(line).rlike("[a-zA-Z]")
    lines = df.select(*rest, line, leads.alias("_leads"))
    tokens = lines.select(*rest, "_leads", F.posexplode(_split(line)).alias("_at", "word"))
    words = tokens.where((F.col("word") != "") | ((F.col("_at") == 0) & F.col("_leads")))
    return words.select(*rest, "word")


def _split(line: str) -> Column:
    return F.split(line, "[^a-zA-Z]+")


def line_word_counts(df: DataFrame, line: str = "line", drop_empty: bool = False) -> DataFrame:
    """One row per distinct word of each line, with its count ``n`` in that line.

    A line's words sit in one row, so they are counted there, sorted and cut into runs: no shuffle.
    """
    rest = [c for c in df.columns if c != line]
    tokens = df.select(*rest, line, _split(line).alias("_tokens"))
    words = tokens.select(*rest, F.sort_array(_words("_tokens", line, drop_empty)).alias("_words"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("_words")),
        lambda i: (i == 1) | (F.element_at("_words", i) != F.element_at("_words", i - 1)),
    )
    starts = F.when(F.size("_words") == 0, F.array().cast("array<int>")).otherwise(starts)
    runs = words.select(*rest, "_words", starts.alias("_starts"))
    counted = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.element_at("_words", start).alias("word"),
            (
                F.coalesce(F.get("_starts", i + 1), F.size("_words") + 1) - start
            ).cast("bigint").alias("n"),
        ),
    )
    return runs.select(*rest, F.inline(counted))


def _words(tokens: str, line: str, drop_empty: bool) -> Column:
    """The token array without the empty tokens that are no words."""
    size = F.size(tokens)
    if drop_empty:
        return F.array_remove(tokens, "")
    trailing = F.element_at(tokens, -1) == ""
    only_separators = (size == 2) & (F.element_at(tokens, 1) == "")
    return (
        F.when(F.col(line) == "", F.col(tokens))
        .when(trailing & only_separators, F.slice(tokens, F.lit(1), F.lit(0)))
        .when(trailing, F.slice(tokens, F.lit(1), size - 1))
        .otherwise(F.col(tokens))
    )
