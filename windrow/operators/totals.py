"""Sums and counts per key and window.

All aggregates here are mergeable: Spark combines on the map side, so a key or a window that holds
a third of all rows reaches the shuffle as one small row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from windrow.functions.durations import micros
from windrow.functions.money import shown, total
from windrow.functions.times import shift
from windrow.operators.windows import Windows, placed, with_bounds


#: Windows that a row falls into, beyond which rows are summed by pane first.
DIRECT_WINDOWS = 2


def amount_totals(
    df: DataFrame,
    windows: Windows,
    key: str | None,
    amount: Column | str,
    ts: str = "ts",
    sum_name: str = "sum_amount",
    count_name: str = "tran_count",
    time_name: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Amount sum and row count per window and key (no key: one row per window).

    ``time_name`` adds the window's last instant, the event time by which a further window
    aggregate can go on, in the same query and on a stream too; ``exact`` leaves the sum in the type
    it was made in, for such a stage.

    Batch, windows that overlap more than twice: rows are aggregated once into the panes the windows
    share and the pane totals are spread over the windows, so the per-row work does not grow with
    size / slide.  Otherwise a row is put into its one or two windows directly, with one shuffle.
    Streams: one stateful aggregate over the windows, so a late row is judged per window.
    """
    keys = [] if key is None else [key]
    rows = df.select(ts, *keys, (F.col(amount) if isinstance(amount, str) else amount).alias("_amount"))
    sums = [total("_amount").alias("_amount"), F.count(F.lit(1)).alias("_rows")]
    if micros(windows.size) > DIRECT_WINDOWS * micros(windows.step) and not df.isStreaming:
        panes = rows.groupBy(windows.pane.of(ts)["start"].alias("_pane"), *keys).agg(*sums)
        grouped = panes.groupBy(placed(panes, windows, "_pane"), *keys)
        totals = grouped.agg(total("_amount").alias("_amount"), F.sum("_rows").alias("_rows"))
    else:
        totals = rows.groupBy(placed(rows, windows, ts), *keys).agg(*sums)
    last = [] if time_name is None else [_last_instant(totals, windows).alias(time_name)]
    return with_bounds(
        totals.select(
            totals.columns[0],
            *keys,
            (F.col("_amount") if exact else shown("_amount")).alias(sum_name),
            F.col("_rows").alias(count_name),
            *last,
        ),
        windows,
    )


def fanned_totals(df: DataFrame, windows: Windows, keys: Sequence[str], amount: str, ts: str = "ts") -> DataFrame:
    """Amount sum and row count per window and each of ``keys`` by itself, of a batch table.

    One scan and one shuffle for all keys: ``branch`` names the key that a row is for, and the other
    keys are null in it.
    """
    rows = df.select(windows.of(ts)["start"].alias("window_start"), *keys, F.col(amount).alias("_amount"))
    sets = rows.groupingSets([["window_start", k] for k in keys], "window_start", *keys)
    totals = sets.agg(
        F.coalesce(*[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]).alias("branch"),
        shown(total("_amount")).alias("sum_amount"),
        F.count(F.lit(1)).alias("tran_count"),
    )
    return with_bounds(totals, windows)


def fanned_stream(df: DataFrame, windows: Windows, keys: dict[str, str], amount: str, ts: str = "ts") -> DataFrame:
    """The same over a stream: ``window_start, window_end, branch, key, sum_amount, tran_count``.

    A row is put into each branch of ``keys`` (name of the branch to the column of its key) before the one
    stateful aggregate, so the source is read once and there is one state.  Keys of all branches are as
    wide as BIGINT.
    """
    rows = branched(df.withColumn("_amount", F.col(amount)), keys, [ts, "_amount"])
    totals = rows.groupBy(placed(rows, windows, ts), "branch", "key").agg(
        shown(total("_amount")).alias("sum_amount"), F.count(F.lit(1)).alias("tran_count")
    )
    return with_bounds(totals, windows)


def branched(df: DataFrame, keys: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """The ``columns`` of each row once for each branch of ``keys``, with ``branch`` and ``key``."""
    branches = F.explode(F.array(*[F.struct(F.lit(name).alias("branch"), F.col(key).cast("bigint").alias("key")) for name, key in keys.items()]))
    return df.select(*columns, branches.alias("_of")).select(*columns, "_of.branch", "_of.key")


def _last_instant(totals: DataFrame, windows: Windows) -> Column:
    if totals.isStreaming:
        return F.window_time("window")
    return shift(shift(F.col("window_start"), windows.size), "1 microsecond", sign=-1)


def pair_totals(pairs: DataFrame, key: str, amount: Column | str) -> DataFrame:
    """Amount sum and row count per window and key of rows that carry their ``window`` already."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    rows = with_bounds(pairs.select("window", key, amount.alias("_amount")))
    return rows.groupBy("window_start", "window_end", key).agg(
        shown(total("_amount")).alias("sum_amount"), F.count(F.lit(1)).alias("tran_count")
    )


def placed_totals(df: DataFrame, windows: Windows, keys: Sequence[str], amount: Column | str, ts: str = "ts") -> DataFrame:
    """``window_start, window_end, *keys, amount, n``: each row as a total of its own in each of its windows."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    rows = df.select(windows.of(ts).alias("window"), *keys, amount.alias("amount"), F.lit(1).cast("bigint").alias("n"))
    return with_bounds(rows)


def merged_totals(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each window and ``keys`` of such totals; amounts in the type in which they are summed."""
    kind = totals.schema["amount"].dataType
    wide = "double" if kind.simpleString() in ("float", "double") else f"decimal(38,{getattr(kind, 'scale', 0)})"
    sums = totals.groupBy("window_start", "window_end", *keys).agg(total("amount").alias("amount"), F.sum("n").alias("n"))
    return sums.withColumn("amount", F.col("amount").cast(wide))


def shown_totals(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged totals as results show them."""
    return totals.select("window_start", "window_end", *keys, shown("amount").alias("sum_amount"), F.col("n").alias("tran_count"))


def windowed_sums(
    df: DataFrame, windows: Windows, keys: Sequence[str], value: str, ts: str, name: str
) -> DataFrame:
    """Sum of an integer column per window and keys, as BIGINT."""
    total = F.sum(F.col(value).cast("bigint")).alias(name)
    return windowed_aggregates(df, windows, keys, [total], ts)


def windowed_aggregates(
    df: DataFrame, windows: Windows, keys: Sequence[str], aggregates: Sequence[Column], ts: str
) -> DataFrame:
    """Any built-in aggregates per window and keys; the hook for one's own window functions."""
    totals = df.groupBy(placed(df, windows, ts), *keys).agg(*aggregates)
    return with_bounds(totals, windows)
