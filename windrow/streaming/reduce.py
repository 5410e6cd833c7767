"""Ordered reduces on a stream whose state is cut by rows: runs of a fixed length, and their merged states.

A row can be reduced once the watermark has passed it, for then nothing older comes any more.  Until then it
waits; after that it stands in the newest run, until this has twice the length of a run and its older half
is reduced and merged with what came before.  Runs are cut and merged as the batch reduce does it, so
the results are the same to the last bit, and no entry of the state has more than ``RUN`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, MapState, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructField, StructType, TimestampType

from windrow.functions.durations import micros
from windrow.functions.times import epoch_micros, from_epoch_micros
from windrow.operators.ordered import RUN
from windrow.operators.windows import READING_WINDOWS, Windows

#: Rows of one group in order: time, tiebreak (the least of numbers for a null), then the values to reduce; None for a null.
Rows = list[tuple]
State = tuple[Any, ...]

_WAITING, _NEWEST = 0, 1


@dataclass
class Reduced:
    """What is reduced of a window's rows so far: the merged runs of the part at hand, and of all parts before."""

    part: State | None = None
    in_part: int = 0
    whole: State | None = None

    def add(self, state: State, merge: Callable[[State, State], State], run: int) -> None:
        self.part = state if self.part is None else merge(self.part, state)
        self.in_part += 1
        if self.in_part == run:
            self.whole = self.part if self.whole is None else merge(self.whole, self.part)
            self.part, self.in_part = None, 0

    def result(self, merge: Callable[[State, State], State]) -> State:
        if self.whole is None or self.part is None:
            return self.part if self.whole is None else self.whole
        return merge(self.whole, self.part)


@dataclass
class OrderedRuns(StatefulProcessor):
    """The reduce of one key's windows; columns and types as :func:`reduced_stream` prepares them."""

    size: int
    offset: int
    run: Callable[[Rows], State]
    merge: Callable[[State, State], State]
    values: str
    state: str
    names: list[str]
    run_rows: int = RUN
    by_clock: bool = False
    handle: StatefulProcessorHandle | None = field(default=None, repr=False)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = [c.split()[1] for c in self.values.split(",")]
        columns = [(n, "<i8" if kind == "bigint" else "<f8") for n, kind in zip(self.names, kinds, strict=True)]
        # a row of the state is its bytes: the client of the state looks at every value it is given
        self.layout = np.dtype([("at", "<i8"), ("tie", "<i8"), *columns, *[(f"no_{n}", "?") for n in self.names]])
        self.rows: MapState = handle.getMapState("rows", "start long, kind int, place int", "rows array<binary>")
        kept = f"waiting int, newest int, in_part int, part struct<{_struct(self.state)}>, whole struct<{_struct(self.state)}>"
        self.sums: MapState = handle.getMapState("sums", "start long", kept)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = 1000 * timerValues.getCurrentProcessingTimeInMs()
        # by the clock nothing waits: all rows of a batch come at one time, and later ones later
        passed = now + 1 if self.by_clock else 1000 * timerValues.getCurrentWatermarkInMs()
        came: list[np.ndarray] = []
        for batch in rows:
            packed = np.empty(len(batch), self.layout)
            for name in self.layout.names:
                packed[name] = now if name == "at" and self.by_clock else batch[name].to_numpy()
            came.append(packed if self.by_clock else packed[packed["at"] >= passed])
        fresh = np.concatenate(came) if came else np.empty(0, self.layout)
        starts = fresh["at"] - (fresh["at"] - self.offset) % self.size
        order = np.argsort(starts, kind="stable")
        found, first = np.unique(starts[order], return_index=True)
        for start, places in zip(found.tolist(), np.split(order, first[1:])):
            if self.sums.getValue((start,)) is None:
                self.handle.registerTimer(self._closes(start))
                self.sums.updateValue((start,), (0, 0, 0, None, None))
            waiting, newest, sums = self._load(start)
            waiting = _ordered(np.concatenate([waiting, fresh[places]]))
            ready = int(np.searchsorted(waiting["at"], passed))
            newest = self._reduce(np.concatenate([newest, waiting[:ready]]), sums)
            self._store(start, waiting[ready:], newest, sums)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        for (start,) in [k for k in self.sums.keys() if self._closes(k[0]) == expiredTimerInfo.getExpiryTimeInMs()]:
            waiting, newest, sums = self._load(start)
            newest = self._reduce(np.concatenate([newest, _ordered(waiting)]), sums)
            sums.add(self.run(self._unpacked(newest)), self.merge, self.run_rows)
            out.append((key[0], start, *sums.result(self.merge)))
            none = np.empty(0, self.layout)
            self._store(start, none, none, None)
        # missing values stay None and not NaN
        return iter([pd.DataFrame(out, dtype=object)]) if out else iter(())

    def _closes(self, start: int) -> int:
        return -(-(start + self.size) // 1000)

    def _unpacked(self, packed: np.ndarray) -> Rows:
        held = [[None if no else v for v, no in zip(packed[n].tolist(), packed[f"no_{n}"].tolist())] for n in self.names]
        return list(zip(packed["at"].tolist(), packed["tie"].tolist(), *held))

    def _reduce(self, newest: np.ndarray, sums: Reduced) -> np.ndarray:
        """Reduces the older runs of ``newest`` and leaves the newest one, of less than two runs' rows."""
        done = 0
        while len(newest) - done >= 2 * self.run_rows:
            sums.add(self.run(self._unpacked(newest[done : done + self.run_rows])), self.merge, self.run_rows)
            done += self.run_rows
        return newest[done:]

    def _load(self, start: int) -> tuple[np.ndarray, np.ndarray, Reduced]:
        n_waiting, n_newest, in_part, part, whole = self.sums.getValue((start,))
        waiting, newest = (
            np.frombuffer(b"".join([r for i in range(n) for r in self.rows.getValue((start, kind, i))[0]]), self.layout)
            for kind, n in ((_WAITING, n_waiting), (_NEWEST, n_newest))
        )
        return waiting, newest, Reduced(None if part is None else tuple(part), in_part, None if whole is None else tuple(whole))

    def _store(self, start: int, waiting: np.ndarray, newest: np.ndarray, sums: Reduced | None) -> None:
        before = self.sums.getValue((start,))
        counts = []
        for kind, rows in ((_WAITING, waiting), (_NEWEST, newest)):
            entries = range(0, len(rows), self.run_rows)
            for place, first in enumerate(entries):
                data, width = rows[first : first + self.run_rows].tobytes(), self.layout.itemsize
                self.rows.updateValue((start, kind, place), ([data[i : i + width] for i in range(0, len(data), width)],))
            for place in range(len(entries), before[kind]):
                self.rows.removeKey((start, kind, place))
            counts.append(len(entries))
        if sums is None:
            self.sums.removeKey((start,))
        else:
            self.sums.updateValue((start,), (*counts, sums.in_part, sums.part, sums.whole))


def _ordered(packed: np.ndarray) -> np.ndarray:
    return packed[np.lexsort((packed["tie"], packed["at"]))]


def _struct(columns: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (c.split() for c in columns.split(",")))


def reduced_stream(
    df: DataFrame,
    windows: Windows,
    key: str,
    ts: str,
    tiebreak: str,
    values: dict[str, Column],
    run: Callable[[Rows], State],
    merge: Callable[[State, State], State],
    state: str,
    run_rows: int = RUN,
    by_clock: bool = False,
) -> DataFrame:
    """``window_start, window_end, key`` and the columns of ``state`` per key and tumbling window of a stream.

    ``run`` takes ordered rows ``(time in epoch microseconds, tiebreak, *values)`` to a state, ``merge``
    two neighbouring states to one; ``values`` are BIGINT or DOUBLE, and ``state`` names its fields in DDL.
    ``ts`` carries the watermark: a row that comes behind it is late and left out, one without a time
    belongs to no window, and rows without a key are one key.  A task holds the rows of a key that came
    in one batch or wait for the watermark; entries of the state hold ``run_rows`` at most.  Needs the state
    store that ``session.STREAM_SETTINGS`` names.

    ``by_clock`` puts rows where the clock stands when they come, in the order of their tiebreak within a batch,
    and hands windows out by it, also while the input is silent; ``ts`` and watermarks then play no part.
    """
    if windows.overlapping:
        raise ValueError("an ordered reduce is defined over tumbling windows")
    kinds = df.select(*[c.alias(n) for n, c in values.items()]).dtypes
    if any(kind not in ("bigint", "double") for _, kind in kinds):
        raise TypeError(f"values are BIGINT or DOUBLE, not {kinds}")
    columns = [c for n, v in values.items() for c in (F.coalesce(v, F.lit(0)).alias(n), v.isNull().alias(f"no_{n}"))]
    # keys go as text, for a null would not equal another one in Python
    name = F.to_json(F.struct(F.col(key).alias("key"))).alias("name")
    timed = df if by_clock else df.filter(F.col(ts).isNotNull())
    rows = timed.select(name, (F.lit(0).cast("long") if by_clock else epoch_micros(ts)).alias("at"), F.coalesce(F.col(tiebreak).cast("long"), F.lit(-(2**63))).alias("tie"), *columns)
    typed = ", ".join(f"{n} {kind}" for n, kind in kinds)
    runs = OrderedRuns(micros(windows.size), micros(windows.offset), run, merge, typed, state, [n for n, _ in kinds], run_rows, by_clock)
    out = f"name string, start long, {state}"
    found = rows.groupBy("name").transformWithStateInPandas(runs, out, "Append", "ProcessingTime" if by_clock else "EventTime")
    named = StructType([StructField("key", df.schema[key].dataType)])
    time = TimestampType() if by_clock else df.schema[ts].dataType
    return found.select(
        from_epoch_micros(F.col("start"), time).alias("window_start"),
        from_epoch_micros(F.col("start") + F.lit(micros(windows.size)), time).alias("window_end"),
        F.from_json("name", named)["key"].alias(key),
        *found.columns[2:],
    )


def halved_stream(
    readings: DataFrame,
    windows: Windows = READING_WINDOWS,
    key: str = "sensor_id",
    value: str = "temperature",
    ts: str = "ts",
    tiebreak: str = "reading_id",
    stamp: str | None = None,
    run_rows: int = RUN,
    by_clock: bool = False,
) -> DataFrame:
    """The halving reduce of :mod:`windrow.operators.halving` with a state cut by rows: ``window_start, window_end,
    key, first_ts, value, n``, equal to the batch form to the last bit.  Of the first reading its time is kept
    or, if given, its ``stamp``, a whole number."""
    found = reduced_stream(
        readings,
        windows,
        key,
        ts,
        tiebreak,
        {"x": F.col(value).cast("double"), **({} if stamp is None else {"stamp": F.col(stamp).cast("long")})},
        _halve,
        _merge_halves,
        "first_at bigint, first double, rows_n bigint, folded double",
        run_rows,
        by_clock,
    )
    first = F.col("first_at")
    if stamp is None:
        first = from_epoch_micros(first, TimestampType() if by_clock else readings.schema[ts].dataType)
    return found.select("window_start", "window_end", key, first.alias("first_ts"), F.col("folded").alias(value), F.col("rows_n").alias("n"))


def _halve(rows: Sequence[tuple]) -> State:
    folded = rows[0][2]
    for row in rows[1:]:
        folded = None if folded is None or row[2] is None else (folded + row[2]) / 2.0
    return (rows[0][3] if len(rows[0]) > 3 else rows[0][0], rows[0][2], len(rows), folded)


def _merge_halves(older: State, newer: State) -> State:
    (at, first, n, a), (_, newer_first, m, b) = older, newer
    scale = 2.0**-m
    if a is None or b is None:
        folded = None
    elif np.isfinite(a) and np.isfinite(b):
        # the newer run's own first value gives way to what came before it
        folded = None if newer_first is None else b + (a * scale - newer_first * scale)
    else:
        folded = a + b
    return (at, first, n + m, folded)
