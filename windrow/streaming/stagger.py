"""Staggered windows on a stream: a key's phase is fixed by its first rows, and timers close its windows.

The phase of a key, and the totals of its windows that are still open, are kept state.  A window is handed
out when the watermark passes its end, at once for all, as other windows are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import DecimalType, StructField, StructType

from windrow.functions.durations import micros
from windrow.functions.times import epoch_micros, from_epoch_micros

#: Digits of an amount that are summed in whole numbers; sums themselves may have any number of digits.
MOST_DIGITS = 18
_HALF = 10**9


def window_totals(starts: np.ndarray, amounts: np.ndarray) -> dict[int, tuple[int, int]]:
    """Per start: the exact sum of whole numbers, and how many there are."""
    found, which = np.unique(starts, return_inverse=True)
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(len(found)))
    high, low = np.divmod(amounts[order], _HALF)  # neither half's sum leaves 64 bits
    highs, lows = np.add.reduceat(high, edges), np.add.reduceat(low, edges)
    return {int(s): (int(h) * _HALF + int(lo), int(n)) for s, h, lo, n in zip(found, highs, lows, np.bincount(which))}


class StaggeredTotals(StatefulProcessor):
    """Sum and count per window of one key; keys and rows as :func:`staggered_totals` prepares them."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.phase = handle.getValueState("phase", "phase long")
        # a sum may have more digits than a long, so it is kept as text
        self.open = handle.getMapState("open", "start long", "amount string, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        passed = 1000 * timerValues.getCurrentWatermarkInMs()
        phase = self.phase.get()[0] if self.phase.exists() else None
        if phase is None:
            # the first rows come together: the earliest of them sets the phase
            rows = list(rows)
            phase = min(int(r["at"].min()) for r in rows) % self.size
            self.phase.update((phase,))
        for batch in rows:
            at = batch["at"].to_numpy(np.int64)
            starts = at - (at - phase) % self.size
            for start, (amount, n) in window_totals(starts, batch["amount"].to_numpy(np.int64)).items():
                if start + self.size <= passed:
                    continue  # late: its window is out
                if (held := self.open.getValue((start,))) is None:
                    self.handle.registerTimer(-(-(start + self.size) // 1000))
                    held = ("0", 0)
                self.open.updateValue((start,), (str(int(held[0]) + amount), held[1] + n))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = None
        for (at,), (amount, n) in list(self.open.iterator()):
            if -(-(at + self.size) // 1000) == expiredTimerInfo.getExpiryTimeInMs():
                start = at
                break
        if start is None:
            return iter(())
        self.open.removeKey((start,))
        return iter([pd.DataFrame({"name": [key[0]], "start": [start], "amount": [amount], "n": [n]})])


def staggered_totals(rows: DataFrame, size: str, key: str, amount: Column | str, ts: str = "ts") -> DataFrame:
    """``window_start, window_end, key, sum_amount, tran_count`` over a stream whose ``ts`` carries a watermark.

    Windows tumble with a phase per key: that of the earliest of the key's rows in the first batch that has
    any.  ``amount`` is a decimal of at most 18 digits and summed exactly.  Rows without a time belong to no
    window; rows without a key are one key.  A row whose window is out already is late and left out.  The
    state of a key is its phase and a sum and a count for each window that is still open; its rows are
    combined within a batch and not kept.  Needs the state store that ``session.STREAM_SETTINGS`` names.
    """
    money = F.col(amount) if isinstance(amount, str) else amount
    # keys go as text, for a null would not equal another one in Python
    typed = rows.select(ts, F.to_json(F.struct(F.col(key).alias("key"))).alias("name"), money.alias("money"))
    kind = typed.schema["money"].dataType
    if not isinstance(kind, DecimalType) or kind.precision > MOST_DIGITS:
        raise TypeError(f"an amount is a decimal of at most {MOST_DIGITS} digits, not {kind.simpleString()}")
    whole = (F.col("money").cast(f"decimal(38,{kind.scale})") * F.lit(10**kind.scale)).cast("long")
    prepared = typed.filter(F.col(ts).isNotNull()).select("name", epoch_micros(ts).alias("at"), F.coalesce(whole, F.lit(0)).alias("amount"))
    length = micros(size)
    out = "name string, start long, amount string, n long"
    totals = prepared.groupBy("name").transformWithStateInPandas(StaggeredTotals(length), out, "Append", "EventTime")
    named = StructType([StructField("key", rows.schema[key].dataType)])
    time = rows.schema[ts].dataType
    exact = (F.col("amount").cast("decimal(38,0)") / F.lit(10**kind.scale)).cast(f"decimal(38,{kind.scale})")
    return totals.select(
        from_epoch_micros(F.col("start"), time).alias("window_start"),
        from_epoch_micros(F.col("start") + F.lit(length), time).alias("window_end"),
        F.from_json("name", named)["key"].alias(key),
        exact.cast("double").alias("sum_amount"),
        F.col("n").alias("tran_count"),
    )
