"""The halving reduce: ``(a, b) -> (a + b) / 2`` folded over a window's readings in arrival order.

Not a mean: the newest reading weighs one half, the one before a quarter, and so on; the first
timestamp is kept.  One step maps the running value ``a`` to ``(a + x) / 2``, so a run of ``n``
readings that folds to ``g`` on its own turns an incoming ``a`` into ``g + (a - first) / 2^n``.  By
that rule runs are folded apart from each other and merged afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from windrow.operators.heavy import ABOVE
from windrow.operators.ordered import windowed_reduce, windowed_reduce_stream
from windrow.operators.windows import READING_WINDOWS, Windows


def halving_reduce(
    readings: DataFrame,
    windows: Windows = READING_WINDOWS,
    key: str = "sensor_id",
    value: str = "temperature",
    ts: str = "ts",
    tiebreak: str = "reading_id",
    stamp: str | None = None,
    chunks: int | None = None,
    split_above: int = ABOVE,
) -> DataFrame:
    """``window_start, window_end, key, first_ts, value, n`` per key and window of a batch table.

    Windows and arrival order go by (``ts``, ``tiebreak``); the first reading's ``stamp`` is kept
    (``ts`` by default).  The rows of a group are reduced in the same runs and merged in the same
    order however they are cut, so the value does not depend on ``chunks`` or ``split_above``.
    """
    reduced = windowed_reduce(
        readings, windows, key, ts, tiebreak, _values(value, stamp or ts), _run, _merge, chunks, split_above
    )
    return _result(reduced, key, value)


def halving_reduce_stream(
    readings: DataFrame,
    windows: Windows = READING_WINDOWS,
    pane: str | None = None,
    key: str = "sensor_id",
    value: str = "temperature",
    ts: str = "ts",
    tiebreak: str = "reading_id",
    stamp: str | None = None,
) -> DataFrame:
    """The same over a stream whose ``ts`` carries a watermark (append mode)."""
    reduced = windowed_reduce_stream(
        readings, windows, key, ts, tiebreak, _values(value, stamp or ts), _run, _merge, pane
    )
    return _result(reduced, key, value)


def _values(value: str, stamp: str) -> dict[str, Column]:
    return {"x": F.col(value).cast("double"), "stamp": F.col(stamp)}


def _run(rows: Column) -> Column:
    rest = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
    folded = F.aggregate(rest, rows[0]["x"], lambda a, row: (a + row["x"]) / F.lit(2.0))
    return F.struct(
        rows[0]["stamp"].alias("stamp"),
        rows[0]["x"].alias("first"),
        F.size(rows).cast("bigint").alias("n"),
        folded.alias("folded"),
    )


def _merge(older: Column, newer: Column) -> Column:
    # Scaled before they are subtracted, so that far ends of the range do not overflow.  What is not
    # finite stays so: infinity halves to infinity, and against its opposite to NaN.
    scale = F.pow(F.lit(2.0), -newer["n"])
    carried = older["folded"] * scale - newer["first"] * scale
    both = F.when(_finite(older["folded"]) & _finite(newer["folded"]), newer["folded"] + carried)
    return F.struct(
        older["stamp"].alias("stamp"),
        older["first"].alias("first"),
        (older["n"] + newer["n"]).alias("n"),
        both.otherwise(older["folded"] + newer["folded"]).alias("folded"),
    )


def _finite(value: Column) -> Column:
    return F.abs(value) < F.lit(float("inf"))


def _result(reduced: DataFrame, key: str, value: str) -> DataFrame:
    return reduced.select(
        "window_start",
        "window_end",
        key,
        F.col("state.stamp").alias("first_ts"),
        F.col("state.folded").alias(value),
        F.col("state.n").alias("n"),
    )
