"""Event-time columns.  Works on TIMESTAMP and TIMESTAMP_NTZ; epochs count from UTC midnight."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

from windrow.functions.durations import micros


def from_epoch_millis(millis: Column | str) -> Column:
    """Event time from an epoch-millisecond field."""
    return F.timestamp_millis(_col(millis))


def epoch_millis(ts: Column | str) -> Column:
    """Epoch milliseconds, floored."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def from_epoch_micros(micros_: Column, kind: DataType) -> Column:
    """A time of type ``kind`` (TIMESTAMP or TIMESTAMP_NTZ) from epoch microseconds."""
    return F.timestamp_micros(micros_).cast(kind)


def arrival_now() -> Column:
    """Wall clock at ingest; one value per micro-batch."""
    return F.current_timestamp()


def date_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def time_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss")


def shift(ts: Column, duration: str, sign: int = 1) -> Column:
    """``ts`` moved by a fixed duration."""
    return ts + F.expr(f"make_dt_interval(0, 0, 0, {sign * micros(duration)} / 1000000BD)")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
