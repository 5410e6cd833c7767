"""Reduces that depend on the order of a group's rows.

A group is cut into runs of neighbouring rows; each run is reduced on its own to a *state*, and the
states are merged in order.  So a key with a third of all rows is reduced by many tasks, and no task
ever holds a whole group, only runs of ``RUN`` rows and the states of such runs.

A reduce is given by two functions of columns:

``run(rows)``
    the state of an ordered, non-empty array of rows (structs that hold the columns to reduce);
``merge(older, newer)``
    the state of two neighbouring runs together.

:func:`associative` makes the pair out of one function that reduces two states to one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from windrow.functions.durations import interval, micros
from windrow.functions.times import epoch_micros, shift
from windrow.operators.chunks import assign_chunks, find_cuts
from windrow.operators.heavy import ABOVE, LIMIT
from windrow.operators.windows import Windows, with_bounds

Run = Callable[[Column], Column]
Merge = Callable[[Column, Column], Column]

# Rows reduced one after the other in one array, and states merged so; longer groups are merged from
# runs, and these from merged ones, so that no array grows with the group but by its millionth part.
RUN = 1024


def associative(step: Merge, *columns: str) -> tuple[Run, Merge]:
    """``(run, merge)`` of an associative function of two neighbouring rows or states.

    It takes two structs with ``columns`` and gives one of just these, in this order and of the same
    types.
    """

    def run(rows: Column) -> Column:
        first = F.struct(*[rows[0][c].alias(c) for c in columns])
        return F.aggregate(_rest(rows), first, step)

    return run, step


def windowed_reduce(
    df: DataFrame,
    windows: Windows,
    key: str,
    ts: str,
    tiebreak: str,
    values: dict[str, Column],
    run: Run,
    merge: Merge,
    chunks: int | None = None,
    split_above: int = ABOVE,
) -> DataFrame:
    """``window_start, window_end, key, state`` per key and tumbling window of a batch table.

    Windows and order go by (``ts``, ``tiebreak``); ``tiebreak`` is an integer that makes the order
    total.  Groups of more than ``split_above`` rows are numbered chunk by chunk of their order, and
    not by one task; runs are the same either way.
    """
    _tumbling(windows)
    # Plain columns, the key first: the sorts compare them by prefix, which a struct has not.
    rows = df.select(
        key,
        windows.of(ts)["start"].alias("window_start"),
        F.col(ts).alias("_ts"),
        F.col(tiebreak).alias("_tie"),
        *_aliased(values),
    )
    group = [key, "window_start"]
    numbered = _numbered(rows, group, chunks, split_above)
    # the newest run takes what is left over: it has from one to two runs' rows, the others one
    last = F.greatest(F.floor(F.col("_n") / RUN), F.lit(1)) - 1
    runs = _reduce_runs(numbered.withColumn("_run", F.least(F.floor(F.col("_at") / RUN), last)), [*group, "_run"], list(values), run)
    merged = _merge_parts(runs.withColumn("_part", F.floor(F.col("_run") / RUN)), [*group, "_part"], F.col("_run"), merge)
    reduced = _merge_parts(merged, group, F.col("_part"), merge)
    end = shift(F.col("window_start"), windows.size).alias("window_end")
    return reduced.select("window_start", end, key, "state")


def windowed_reduce_stream(
    df: DataFrame,
    windows: Windows,
    key: str,
    ts: str,
    tiebreak: str,
    values: dict[str, Column],
    run: Run,
    merge: Merge,
    pane: str | None = None,
) -> DataFrame:
    """The same over a stream whose ``ts`` carries a watermark (append mode).

    Rows of one pane (an even share of the window, a tenth by default) of one key are kept and
    reduced together; the window keeps one state per pane.  ``pane`` bounds what a hot key can pile
    up.
    """
    _tumbling(windows)
    pane_size = micros(pane) if pane else micros(windows.size) // 10
    if micros(windows.size) % pane_size:
        raise ValueError("the pane must divide the window")
    panes = Windows(interval(pane_size), None, interval(micros(windows.offset) % pane_size))
    rows = df.select(
        panes.of(ts).alias("pane"),
        key,
        F.col(ts).alias("_ts"),
        F.col(tiebreak).alias("_tie"),
        *_aliased(values),
    )
    runs = _reduce_runs(rows, ["pane", key], list(values), run)
    runs = runs.select(F.window_time("pane").alias("_at"), key, "state")
    merged = _merge_parts(
        runs.withColumn("window", windows.of("_at")), ["window", key], F.col("_at"), merge
    )
    return with_bounds(merged)


def _tumbling(windows: Windows) -> None:
    if windows.overlapping:
        raise ValueError("an ordered reduce is defined over tumbling windows")


def _aliased(values: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in values.items()]


def _numbered(
    rows: DataFrame, group: Sequence[str], chunks: int | None, split_above: int
) -> DataFrame:
    """Add ``_at`` and ``_n``: the number of older rows in the row's group, and of all.

    Where no group is heavy these are two windows over one shuffle.  Else a row's number is that in its chunk
    plus the rows of its group's older chunks.
    """
    oldest_first = ("_ts", "_tie")
    cut = _cut_heavy(rows, group, chunks, split_above)
    if cut is None:
        at = F.row_number().over(Window.partitionBy(*group).orderBy(*oldest_first)) - 1
        return rows.withColumn("_at", at).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    # a struct of the group equals another one though it holds nulls
    cut = cut.withColumn("_group", F.struct(*group))
    older = Window.partitionBy("_group").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_group", "chunk").agg(F.count(F.lit(1)).alias("_size"))
    floors = sizes.select(
        "_group", "chunk", F.coalesce(F.sum("_size").over(older), F.lit(0)).alias("_older"), F.sum("_size").over(Window.partitionBy("_group")).alias("_n")
    )
    inside = F.row_number().over(Window.partitionBy("_group", "chunk").orderBy(*oldest_first)) - 1
    joined = cut.join(floors, ["_group", "chunk"]).withColumn("_at", F.col("_older") + inside)
    return joined.select(*rows.columns, "_at", "_n")


def _cut_heavy(
    rows: DataFrame, group: Sequence[str], chunks: int | None, split_above: int
) -> DataFrame | None:
    """Add ``chunk``: cuts of the time order for the heavy groups, however many, and 0 for all others.
    None if no group is heavy."""
    counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    # Kept for the two passes of this function.
    heavy = counted.where(F.col("_rows") > split_above).persist()
    try:
        n = heavy.count()
        if not n:
            return None
        named = heavy.select(*[F.col(c).alias(f"_heavy_{c}") for c in group], "_rows")
        named = F.broadcast(named) if n <= LIMIT else named
        order = (epoch_micros("_ts"), F.col("_tie"))
        cuts = find_cuts(rows, *order, chunks, lambda df: df.join(named, _same(df, group), "left_semi"))
    finally:
        heavy.unpersist()
    marked = assign_chunks(rows.join(named, _same(rows, group), "left"), cuts, *order)
    chunk = F.when(F.col("_rows").isNotNull(), F.col("chunk")).otherwise(F.lit(0))
    return marked.select(*rows.columns, chunk.alias("chunk"))


def _same(df: DataFrame, group: Sequence[str]) -> Column:
    return reduce(and_, [df[c].eqNullSafe(F.col(f"_heavy_{c}")) for c in group])


def _reduce_runs(
    rows: DataFrame, keys: Sequence[str], values: list[str], run: Run
) -> DataFrame:
    gathered = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_ts", "_tie", *values))).alias("_rows")
    )
    return gathered.select(*keys, run(F.col("_rows")).alias("state"))


def _merge_parts(parts: DataFrame, keys: Sequence[str], position: Column, merge: Merge) -> DataFrame:
    """One state per ``keys`` group out of the states of its parts, oldest ``position`` first."""
    gathered = parts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(position.alias("_at"), "state"))).alias("_parts")
    )
    ordered = F.col("_parts")
    merged = F.aggregate(
        _rest(ordered), ordered[0]["state"], lambda state, part: merge(state, part["state"])
    )
    return gathered.select(*keys, merged.alias("state"))


def _rest(rows: Column) -> Column:
    return F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
