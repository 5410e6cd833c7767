"""Second stage: global roll-up of per-key window totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from windrow.functions.money import shown, total
from windrow.functions.times import shift
from windrow.operators.totals import merged_totals
from windrow.operators.windows import ROLLUP_WINDOWS, Windows, placed, with_bounds


def window_time(totals: DataFrame) -> DataFrame:
    """Totals with ``ts``, the last instant of their window, as their event time."""
    return totals.withColumn("ts", shift(F.col("window_end"), "1 microsecond", sign=-1))


def global_rollup(
    totals: DataFrame, windows: Windows = ROLLUP_WINDOWS, ts: str = "ts"
) -> DataFrame:
    """Total count and amount per window over all keys.

    A transaction that sits in several sliding windows of the first stage counts once for each.
    The last reducer gets one row per task and window, never the rows themselves.
    """
    rows = totals.select(ts, "tran_count", "sum_amount")
    rolled = rows.groupBy(placed(rows, windows, ts)).agg(
        F.sum("tran_count").alias("tran_count"), shown(total("sum_amount")).alias("sum_amount")
    )
    return with_bounds(rolled, windows)


def placed_rollup(totals: DataFrame, windows: Windows = ROLLUP_WINDOWS, ts: str = "ts") -> DataFrame:
    """Per-key totals in the windows of the roll-up, as :func:`merged_rollup` takes them."""
    rows = totals.select(placed(totals, windows, ts), "tran_count", F.col("sum_amount").alias("amount"))
    return with_bounds(rows, windows)


def merged_rollup(rows: DataFrame) -> DataFrame:
    """One row for each window; amounts in the type in which they are summed."""
    return merged_totals(rows.withColumnRenamed("tran_count", "n"), []).select("window_start", "window_end", F.col("n").alias("tran_count"), "amount")


def shown_rollup(rows: DataFrame) -> DataFrame:
    return rows.select("window_start", "window_end", "tran_count", shown("amount").alias("sum_amount"))
