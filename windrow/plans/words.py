"""Word counts of text lines, per line and per tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from windrow.functions.text import explode_lines, explode_words
from windrow.operators.windows import WORD_WINDOWS, Windows, placed, with_bounds


def word_totals(
    lines: DataFrame,
    windows: Windows = WORD_WINDOWS,
    line: str = "line",
    ts: str = "ts",
    drop_empty: bool = False,
) -> DataFrame:
    """Words counted per window.

    Map-side combining does the per-line pre-count, and more.  The window is found once per line,
    before the line is cut into words.
    """
    windowed = lines.select(placed(lines, windows, ts), line)
    counts = explode_words(windowed, line, drop_empty).groupBy(windowed.columns[0], "word")
    return with_bounds(counts.agg(F.count(F.lit(1)).alias("n")), windows)


def placed_words(lines: DataFrame, windows: Windows = WORD_WINDOWS, line: str = "line", ts: str = "ts", drop_empty: bool = False) -> DataFrame:
    """``window_start, window_end, word, n``: each word of a batch's lines as a count of its own."""
    windowed = with_bounds(lines.select(windows.of(ts).alias("window"), line))
    return explode_words(windowed, line, drop_empty).withColumn("n", F.lit(1).cast("bigint"))


def merged_words(counts: DataFrame) -> DataFrame:
    """One row for each window and word of such counts."""
    return counts.groupBy("window_start", "window_end", "word").agg(F.sum("n").alias("n"))


def text_word_totals(texts: DataFrame, windows: Windows = WORD_WINDOWS) -> DataFrame:
    """The same for a table of whole texts with an event time."""
    return word_totals(explode_lines(texts.select("ts", "text")), windows)
