"""Which rows come too late, judged row by row on a batch table.

Every source partition has its own watermark: the greatest event time seen so far, minus a delay.
A window is closed once the watermark reaches its end; a row that still belongs to a closed window
is late for that window.  (On a stream, ``withWatermark`` applies the rule per micro-batch.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from windrow.functions.durations import micros
from windrow.functions.times import epoch_micros, shift
from windrow.operators.chunks import with_chunks
from windrow.operators.windows import RETAIL_DELAY, RETAIL_WINDOWS, Windows


def with_seen(
    df: DataFrame,
    source: str = "source_partition",
    arrival: str = "arrival",
    tiebreak: str = "row_id",
    ts: str = "ts",
    chunks: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add ``seen``: the greatest ``ts`` among earlier rows of the same source (null for the first).

    ``before`` (``source``, ``ts``) tells what each source had shown before these rows, one row per
    source.

    ``arrival`` and ``tiebreak`` are integers that order a source's rows.  The running maximum is
    taken inside (source, chunk) groups and topped up with the maximum of the source's earlier
    chunks, so one busy source is spread over all tasks.  Join and window share one shuffle.  Rows
    without a source are one source: a struct of a null equals another one, which a null does not.
    """
    chunked = with_chunks(df, F.col(arrival), F.col(tiebreak), chunks).withColumn("_source", F.struct(source))
    tops = chunked.groupBy("_source", "chunk").agg(F.max(ts).alias("_top"))
    if before is not None:
        earlier = before.select(F.struct(source).alias("_source"), F.lit(-1).alias("chunk"), F.col(ts).alias("_top"))
        tops = tops.unionByName(earlier)
    earlier_chunks = (
        Window.partitionBy("_source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    floors = tops.select(
        "_source", "chunk", F.max("_top").over(earlier_chunks).alias("_floor")
    )
    earlier_rows = (
        Window.partitionBy("_source", "chunk")
        .orderBy(arrival, tiebreak)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.join(floors, ["_source", "chunk"])
        .withColumn("seen", F.greatest("_floor", F.max(ts).over(earlier_rows)))
        .drop("_source", "chunk", "_floor")
    )


def closed(end_micros: Column, seen: Column, delay: str) -> Column:
    """True where the watermark had reached the window's end before the row came."""
    return F.coalesce(end_micros <= epoch_micros(seen) - F.lit(micros(delay)), F.lit(False))


def last_window_end(ts: Column, windows: Windows) -> Column:
    """End of the youngest window that covers ``ts``, in epoch microseconds."""
    at = epoch_micros(ts)
    into = F.pmod(at - F.lit(micros(windows.offset)), F.lit(micros(windows.step)))
    return at - into + F.lit(micros(windows.size))


def flag_late(
    df: DataFrame,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    ts: str = "ts",
    **order,
) -> DataFrame:
    """Add ``late``: true where every window the row belongs to had closed when it came."""
    seen = with_seen(df, ts=ts, **order)
    is_late = closed(last_window_end(F.col(ts), windows), F.col("seen"), delay)
    return seen.withColumn("late", is_late).drop("seen")


def split_late(
    df: DataFrame,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    ts: str = "ts",
    **order,
) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)`` rows; use :func:`flag_late` where one pass has to feed both."""
    flagged = flag_late(df, windows, delay, ts, **order)
    return flagged.where(~F.col("late")).drop("late"), flagged.where("late").drop("late")


def on_time_pairs(
    df: DataFrame,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    ts: str = "ts",
    **order,
) -> DataFrame:
    """Rows with the ``window`` they count for, one row per window still open on arrival."""
    pairs = flag_late_pairs(df, windows, delay, ts, **order)
    return pairs.where(~F.col("late")).drop("late")


def flag_late_pairs(
    df: DataFrame,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    ts: str = "ts",
    **order,
) -> DataFrame:
    """One row per row and ``window`` that covers it, with ``late``: true where the window had closed."""
    pairs = with_seen(df, ts=ts, **order).withColumn("window", windows.of(ts))
    is_late = closed(epoch_micros("window.end"), F.col("seen"), delay)
    return pairs.withColumn("late", is_late).drop("seen")


def closed_windows(
    totals: DataFrame, rows: DataFrame, delay: str = RETAIL_DELAY, ts: str = "ts"
) -> DataFrame:
    """Totals of the windows a stream over ``rows`` would have emitted by its last row.

    The cut is one number; Catalyst moves the comparison below the aggregate, so rows of windows
    that stay open are not shuffled.
    """
    cut = rows.agg(shift(F.max(ts), delay, sign=-1)).scalar()
    return totals.where(F.col("window_end") <= cut)
