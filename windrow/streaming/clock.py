"""Windows by the clock: rows count where the clock stands when they come, and timers hand the windows out.

No second source is needed to keep the clock going: with processing-time timers Spark goes on looking at the state
while the input is silent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructField, StructType

from windrow.functions.durations import micros
from windrow.functions.times import from_epoch_micros
from windrow.operators.windows import Windows


class ClockSums(StatefulProcessor):
    """The sums of one key's windows of the clock."""

    def __init__(self, size: int, offset: int):
        self.size, self.offset = size, offset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a sum may have more digits than a long, so it is kept as text
        self.open = handle.getMapState("open", "start long", "n string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = 1000 * timerValues.getCurrentProcessingTimeInMs()
        start = now - (now - self.offset) % self.size
        more = sum(sum(batch["n"].tolist()) for batch in rows)
        if (held := self.open.getValue((start,))) is None:
            self.handle.registerTimer(-(-(start + self.size) // 1000))
            held = ("0",)
        self.open.updateValue((start,), (str(int(held[0]) + more),))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        for (start,), (n,) in list(self.open.iterator()):
            if -(-(start + self.size) // 1000) <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.removeKey((start,))
                out.append((key[0], start, n))
        return iter([pd.DataFrame(out, columns=["name", "start", "n"])]) if out else iter(())


def clock_sums(df: DataFrame, windows: Windows, key: str, value: str, name: str) -> DataFrame:
    """``window_start, window_end, key`` and the sum of the whole numbers ``value`` as ``name``, over a stream, by
    tumbling windows of the clock.

    Rows without a key are one key; null values count nothing.  All rows of a batch come at one time, so each
    task adds up its own per key before they are shuffled: a hot key is a row for each Arrow batch.  Needs the
    state store that ``session.STREAM_SETTINGS`` names.
    """
    if windows.overlapping:
        raise ValueError("windows of the clock are tumbling ones")
    # keys go as text, for a null would not equal another one in Python
    rows = df.select(F.to_json(F.struct(F.col(key).alias("key"))).alias("name"), F.coalesce(F.col(value).cast("long"), F.lit(0)).alias("n"))

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sums = pa.Table.from_batches([batch]).group_by("name").aggregate([("n", "sum")])
                yield from sums.select(["name", "n_sum"]).rename_columns(["name", "n"]).to_batches()

    sums = rows.mapInArrow(combined, "name string, n long").groupBy("name")
    clocked = ClockSums(micros(windows.size), micros(windows.offset))
    found = sums.transformWithStateInPandas(clocked, "name string, start long, n string", "Append", "ProcessingTime")
    named = StructType([StructField("key", df.schema[key].dataType)])
    time = StructType.fromDDL("t timestamp")["t"].dataType
    return found.select(
        from_epoch_micros(F.col("start"), time).alias("window_start"),
        from_epoch_micros(F.col("start") + F.lit(micros(windows.size)), time).alias("window_end"),
        F.from_json("name", named)["key"].alias(key),
        F.col("n").cast("bigint").alias(name),
    )
