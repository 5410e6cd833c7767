"""Totals of windows by micro-batch: those that the watermark has passed go out, open ones are a table.

Only what is still open at the end of a batch is kept, so a window that begins and ends within one batch never
is.  What a batch keeps, it writes under its own number, and reads what its predecessor has left: a batch that
is tried again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from windrow.functions.durations import micros
from windrow.functions.times import epoch_micros
from windrow.operators.windows import NO_DELAY
from windrow.session import names_in, remove_folder

Body = Callable[[DataFrame, int], None]


def closing(
    folder: str,
    emit: Body,
    parts: Callable[[DataFrame], DataFrame],
    merged: Callable[[DataFrame], DataFrame],
    delay: str = NO_DELAY,
    ts: str = "ts",
) -> Body:
    """A ``foreachBatch`` body: the totals of each window, once, when the watermark has passed its end.

    ``parts`` puts the rows of a batch into their windows (``window_start``, ``window_end``), ``merged`` sums up
    what is of one window and key, and takes its own results too.  The watermark is the greatest ``ts`` so far
    less ``delay``; windows that it had passed before the batch take no rows any more.  Open windows are
    a table under ``folder`` (a shared folder).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = _Kept(batch, batch_id, folder, delay, ts)
        rows = parts(batch)
        if kept.before is not None:
            rows = rows.where(epoch_micros("window_end") > kept.before)
        kind = merged(rows).schema
        if (open_ones := kept.rows(kind)) is not None:
            rows = rows.unionByName(open_ones)
        # the sums of closed and of open windows are two jobs, so none of them is held in between
        passed = F.lit(False) if kept.passed is None else epoch_micros("window_end") <= kept.passed
        emit(merged(rows.where(passed)), batch_id)
        kept.write(merged(rows.where(~passed)))

    return write


def once(folder: str, body: Body, keys: Sequence[str], delay: str = NO_DELAY, ts: str = "ts") -> Body:
    """A ``foreachBatch`` body that hands ``body`` the first row of each of ``keys``, and none that comes again
    within ``delay`` of the watermark, as ``dropDuplicatesWithinWatermark`` would; rows behind it are late."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.dropDuplicates(list(keys)).persist()
        try:
            kept = _Kept(batch, batch_id, folder, delay, ts)
            told = batch.select(*keys, ts)
            fresh = batch
            if (seen := kept.rows(told.schema)) is not None:
                told = told.where(epoch_micros(ts) > kept.before).unionByName(seen)
                seen = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
                again = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
                fresh = batch.where(epoch_micros(ts) > kept.before).join(seen, again, "left_anti")
            body(fresh, batch_id)
            kept.write(told if kept.passed is None else told.where(epoch_micros(ts) + micros(delay) > kept.passed))
        finally:
            batch.unpersist()

    return write


class _Kept:
    """What the batch before has left in a folder, and the watermark (in epoch microseconds) before and after this one."""

    def __init__(self, batch: DataFrame, batch_id: int, folder: str, delay: str, ts: str):
        self.spark, self.id, self.folder = batch.sparkSession, batch_id, folder
        self.last = self._last(below=batch_id)
        self.before = None if self.last is None else self.spark.read.parquet(f"{self._place(self.last)}/passed").first()[0]
        latest = batch.agg(F.max(epoch_micros(ts))).first()[0]
        self.passed = max((x for x in (self.before, None if latest is None else latest - micros(delay)) if x is not None), default=None)

    def rows(self, kind) -> DataFrame | None:
        return None if self.last is None else self.spark.read.schema(kind).parquet(f"{self._place(self.last)}/rows")

    def write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self._place(self.id)}/rows")
        passed = self.spark.range(1).select(F.lit(self.passed).cast("bigint").alias("passed"))
        passed.coalesce(1).write.mode("overwrite").parquet(f"{self._place(self.id)}/passed")
        # the batch before may be asked for again, when this one is tried again
        if (old := self._last(below=self.id - 1)) is not None:
            remove_folder(self.spark, self._place(old))

    def _place(self, batch_id: int) -> str:
        return f"{self.folder}/batch={batch_id}"

    def _last(self, below: int) -> int | None:
        ids = [int(n.partition("=")[2]) for n in names_in(self.spark, self.folder) if n.startswith("batch=")]
        return max((i for i in ids if i < below), default=None)
