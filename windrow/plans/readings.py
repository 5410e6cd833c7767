"""Sensor readings reduced by halving in tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from windrow.operators.halving import halving_reduce, halving_reduce_stream
from windrow.operators.windows import READING_WINDOWS, Windows


def halved_readings(
    readings: DataFrame, windows: Windows = READING_WINDOWS, ts: str = "ts", **columns
) -> DataFrame:
    """One row per sensor and window, batch or stream.

    Window by event time or, with ``ts`` naming the arrival column and ``stamp`` the reading's own
    time, by the time readings came in.
    """
    reduce = halving_reduce_stream if readings.isStreaming else halving_reduce
    return reduce(readings, windows, ts=ts, **columns)
