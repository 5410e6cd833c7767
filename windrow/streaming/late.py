"""Late rows and late (row, window) pairs of a stream, by the same row-by-row rules as the batch operators."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from windrow.functions.durations import micros
from windrow.functions.times import shift
from windrow.operators.lateness import flag_late, flag_late_pairs
from windrow.operators.totals import merged_totals, shown_totals
from windrow.operators.windows import RETAIL_DELAY, RETAIL_WINDOWS, Windows, with_bounds
from windrow.session import names_in, remove_folder

Body = Callable[[DataFrame, int], None]


def late_split(
    folder: str,
    main: Body,
    side: Body,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    source: str = "source_partition",
    ts: str = "ts",
    **order,
) -> Body:
    """A ``foreachBatch`` body: on-time rows to ``main``, rows late for all their windows to ``side``.

    What each source has shown so far is a small table under ``folder`` (a shared folder), one row
    per source.  Two copies take turns: a batch reads the one its predecessor wrote and replaces the
    other, so a retried batch gives the same split.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before, _ = _seen_before(batch, batch_id, folder, source, ts)
            flagged = flag_late(
                batch, windows, delay, ts, source=source, before=before, **order
            ).persist()
            try:
                main(flagged.where(~F.col("late")).drop("late"), batch_id)
                side(flagged.where("late").drop("late"), batch_id)
            finally:
                flagged.unpersist()
        finally:
            batch.unpersist()

    return write


def pair_split(
    folder: str,
    totals: Body,
    late: Body,
    key: str,
    amount: str,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    source: str = "source_partition",
    ts: str = "ts",
    idle: str | None = None,
    clock: Callable[[], float] = time.time,
    **order,
) -> Body:
    """A ``foreachBatch`` body: each row counts for those of its windows that are open when it comes.

    Totals (``window_start, window_end, key, amount, n``) of windows that every source has passed go to
    ``totals``; the pairs of a row and a window that had closed go to ``late``, with the window's bounds.
    Windows still open are a table of partial totals under ``folder`` (a shared folder): a batch merges its
    own with those its predecessor left and writes them anew under its own number, so a batch that
    is tried again changes nothing.  A source that comes late may still add to a window that is
    out: that total comes as a further row, and :func:`summed` adds up what belongs together.

    A source that has shown nothing for as long as ``idle`` says, by ``clock`` in seconds, no longer holds
    windows back.  It loses no row by that: lateness goes by what the source itself has shown.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before, shown_now = _seen_before(batch, batch_id, f"{folder}/seen", source, ts, clock())
            pairs = flag_late_pairs(batch, windows, delay, ts, source=source, before=before, **order).persist()
            try:
                late(with_bounds(pairs.where("late").drop("late")), batch_id)
                fresh = with_bounds(pairs.where(~F.col("late")).select("window", key, amount))
                partial = merged_totals(fresh.select("window_start", "window_end", key, F.col(amount).alias("amount"), F.lit(1).cast("bigint").alias("n")), [key])
                if (before_id := _last(spark, folder, below=batch_id)) is not None:
                    partial = merged_totals(partial.unionByName(_open(spark, folder, before_id, partial)), [key])
                # one number: how far the slowest source has come that is not idle; if all are, the fastest one
                awake = F.lit(True) if idle is None else F.col("heard") > F.lit(clock() - micros(idle) / 1e6)
                slowest, fastest = F.min(F.when(awake, F.col(ts))), F.max(ts)
                passed = shown_now.agg(shift(F.coalesce(slowest, fastest), delay, sign=-1)).first()[0]
                partial = partial.persist()
                try:
                    closed = F.lit(False) if passed is None else F.col("window_end") <= F.lit(passed)
                    totals(partial.where(closed), batch_id)
                    partial.where(~closed).write.mode("overwrite").parquet(_place(folder, batch_id))
                finally:
                    partial.unpersist()
            finally:
                pairs.unpersist()
        finally:
            batch.unpersist()
        if (old := _last(spark, folder, below=batch_id - 1)) is not None:
            remove_folder(spark, _place(folder, old))

    return write


def open_totals(spark: SparkSession, folder: str) -> DataFrame | None:
    """The totals of the windows that are still open under the ``folder`` of :func:`pair_split`; None before any batch."""
    last = _last(spark, folder)
    return None if last is None else spark.read.parquet(_place(folder, last))


def summed(totals: DataFrame, key: str) -> DataFrame:
    """``window_start, window_end, key, sum_amount, tran_count``: one row for each window and key of ``totals``."""
    return shown_totals(merged_totals(totals, [key]), [key])


def _seen_before(batch: DataFrame, batch_id: int, folder: str, source: str, ts: str, now: float = 0.0) -> tuple[DataFrame | None, DataFrame]:
    """What each source had shown before the batch, and what it has now and when it was last heard, which is
    written in its turn."""
    latest = [F.max(ts).alias(ts), F.max("heard").alias("heard")]
    shown_now = batch.withColumn("heard", F.lit(now)).groupBy(source).agg(*latest)
    reader = batch.sparkSession.read.schema(shown_now.schema)
    before = None
    if batch_id > 0:
        before = reader.parquet(f"{folder}/turn={(batch_id - 1) % 2}")
        shown_now = shown_now.unionByName(before).groupBy(source).agg(*latest)
        before = before.drop("heard")
    shown_now.write.mode("overwrite").parquet(f"{folder}/turn={batch_id % 2}")
    return before, reader.parquet(f"{folder}/turn={batch_id % 2}")


def _place(folder: str, batch_id: int) -> str:
    return f"{folder}/open/batch={batch_id}"


def _last(spark: SparkSession, folder: str, below: int | None = None) -> int | None:
    """The last batch, before ``below``, whose open windows are kept: two at most are."""
    ids = [int(n.partition("=")[2]) for n in names_in(spark, f"{folder}/open") if n.startswith("batch=")]
    return max((i for i in ids if below is None or i < below), default=None)


def _open(spark: SparkSession, folder: str, batch_id: int, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(_place(folder, batch_id))
