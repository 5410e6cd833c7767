"""Cut an ordered data set into balanced, order-preserving chunks.

An operator that depends on row order inside a group (a running maximum, an ordered reduce) would
sort each group in one task.  With a ``chunk`` column that grows with the order, the work is
grouped by (key, chunk) instead, and a small second step stitches the chunks of a key together.
No chunk holds much more than ``1 / chunks`` of the rows, even where a third of all rows share one
key or one instant.  Results never depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

# Chunks per shuffle partition: these are hashed onto the partitions, where a few even out.
PER_PARTITION = 4
# Integers up to here are exact in a double; this bears on the balance of chunks, never on results.  A single value further than that from the least one is
# not cut by the minor order, however many rows it has: all of them go to one chunk.
_EXACT = 2**53


def default_chunks(df: DataFrame) -> int:
    return PER_PARTITION * max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class Cuts:
    """Where an order by (major, minor) is cut: at ``edges`` of major and, for the ``heavy`` values
    of major that fill whole chunks, at ``minor_edges``.  Edges count from their base."""

    base: int = 0
    edges: tuple[int, ...] = ()
    heavy: tuple[int, ...] = ()
    minor_base: int = 0
    minor_edges: tuple[int, ...] = ()


def with_chunks(
    df: DataFrame, major: Column, minor: Column, chunks: int | None = None
) -> DataFrame:
    """Add ``chunk`` (BIGINT), non-decreasing in the order (``major``, ``minor``), both integral."""
    return assign_chunks(df, find_cuts(df, major, minor, chunks), major, minor)


def find_cuts(
    df: DataFrame,
    major: Column,
    minor: Column,
    chunks: int | None = None,
    narrow: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Cuts:
    """Cuts that balance the rows ``narrow`` leaves of ``df``.

    One quantile pass over ``major`` and, only where single values fill whole chunks, one over
    ``minor``.  Tasks keep sketches of fixed size, which one task merges.  The driver sees the cuts
    (``chunks`` numbers), never rows.
    """
    chunks = chunks or default_chunks(df)
    seen = narrow(df)
    cuts, base = _quantiles(seen, major, chunks)
    # A value cut at twice fills at least one chunk on its own; it can be told from its neighbours
    # only where a double still holds every integer.
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b and abs(a - base) < _EXACT})
    edges = sorted({c - base for c in cuts} | {c - base + 1 for c in heavy})
    if not heavy:
        return Cuts(base, tuple(edges))
    minor_cuts, minor_base = _quantiles(seen.where(major.isin(heavy)), minor, chunks)
    minor_edges = sorted({c - minor_base for c in minor_cuts})
    return Cuts(base, tuple(edges), tuple(heavy), minor_base, tuple(minor_edges))


def assign_chunks(df: DataFrame, cuts: Cuts, major: Column, minor: Column) -> DataFrame:
    """Add ``chunk`` by given cuts."""
    if not cuts.edges:
        return df.withColumn("chunk", F.lit(0).cast("bigint"))
    chunked = _bucket(df, major, cuts.base, cuts.edges, "chunk")
    if not cuts.heavy:
        return chunked
    chunked = _bucket(chunked, minor, cuts.minor_base, cuts.minor_edges, "_minor")
    within = F.when(major.isin(list(cuts.heavy)), F.col("_minor")).otherwise(F.lit(0))
    chunk = F.col("chunk") * (len(cuts.minor_edges) + 2) + within
    return chunked.withColumn("chunk", chunk).drop("_minor")


def _quantiles(df: DataFrame, value: Column, chunks: int) -> tuple[list[int], int]:
    """The ``chunks - 1`` inner quantiles and the origin to measure from; none for no rows."""
    shares = [i / chunks for i in range(1, chunks)] or [0.5]
    row = df.agg(
        F.percentile_approx(value, shares, max(10_000, 4 * chunks)).alias("cuts"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ).first()
    if not row["cuts"]:
        return [], 0
    return list(row["cuts"]), row["low"] if row["high"] - row["low"] < _EXACT else 0


def _bucket(df: DataFrame, value: Column, base: int, edges: Sequence[int], name: str) -> DataFrame:
    """``name`` := number of ``edges`` at or below ``value - base``, by binary search in the JVM.

    Offsets from the origin keep microsecond times exact in a double for 285 years; beyond 2^53
    the cast is still monotone, so order is kept and only the balance may suffer.
    """
    splits = sorted({float(e) for e in edges})
    finder = Bucketizer(
        splits=[float("-inf"), *splits, float("inf")],
        inputCol="_offset",
        outputCol="_bucket",
        handleInvalid="keep",
    )
    found = finder.transform(df.withColumn("_offset", (value - F.lit(base)).cast("double")))
    return found.withColumn(name, F.col("_bucket").cast("bigint")).drop("_offset", "_bucket")
