"""Approximate nearest neighbours: p-stable hashing whose perturbed buckets are visited in order of success."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from windrow.llm.shared import checkpointed, first_rows, mapped, sized, written

#: Neighbours of a query.
NEAREST = 10
#: Hash tables.
TABLES = 2
#: Rows that a bucket holds on average; the number of projections follows from it.
BUCKET_ROWS = 4096
#: Width of a bucket along a projection, in distances of a last neighbour.
WIDTH = 2.0
#: Buckets are visited until a last neighbour is in one of them with this probability.
SUCCESS = 0.97
#: Queries whose exact neighbours, among all rows, tell how far a last neighbour is.
SAMPLE = 64
#: That distance is the one that so many of them stay under.
SAMPLE_SHARE = 0.9
#: Rows and queries of a bucket that meet in one task at a time.
MOST_ROWS, MOST_QUERIES = 8192, 1024
#: A perturbation less likely than this along one projection is not considered.
_UNLIKELY = 1e-6


@dataclass(frozen=True)
class Hashing:
    """Projections of each table, their width and the distance that probes reckon with."""

    tables: int
    projections: int
    width: float
    reach: float
    success: float

    @staticmethod
    def of(rows: int, reach: float, spread: float, tables: int, bucket_rows: int, success: float) -> Hashing:
        """As many projections as it takes for buckets of ``bucket_rows`` rows.

        ``spread`` is the standard deviation of a projection.  Cut into cells of a width, a normal
        variable has an entropy of log(spread * sqrt(2 pi e) / width): so many cells count.
        """
        width = WIDTH * reach
        cells = max(1.5, spread * sqrt(2 * np.pi * np.e) / width)
        wanted = ceil(log(max(1.0, rows / bucket_rows)) / log(cells))
        return Hashing(tables, max(1, wanted), width, reach, 1 - (1 - success) ** (1 / tables))

    def projected(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Where vectors lie along a table's projections, in cells; the projections follow from its number."""
        rng = np.random.default_rng([table, vectors.shape[1]])
        directions = rng.standard_normal((vectors.shape[1], self.projections))
        return np.clip(vectors @ directions / self.width + rng.uniform(0, 1, self.projections), -(2.0**52), 2.0**52)

    def bucket(self, cells: np.ndarray, table: int, length: int) -> int:
        """The name of a bucket; should two share one, they are searched together."""
        return xxhash.xxh64_intdigest(cells.astype("<i8").tobytes(), table * 65_537 + length) - 2**63

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        out = np.empty((len(vectors), self.tables), np.int64)
        for table in range(self.tables):
            cells, which = np.unique(np.floor(self.projected(vectors, table)).astype(np.int64), axis=0, return_inverse=True)
            names = np.array([self.bucket(c, table, vectors.shape[1]) for c in cells], np.int64)
            out[:, table] = names[which.ravel()]
        return out

    def probes(self, vector: np.ndarray) -> Iterator[int]:
        """The buckets to visit, table by table, the likeliest first."""
        for table in range(self.tables):
            at = self.projected(vector[None, :], table)[0]
            home = np.floor(at)
            steps = [self._steps(a - h) for a, h in zip(at, home)]
            for step in in_order(steps, self.success):
                yield self.bucket(home + np.array(step), table, len(vector))

    def _steps(self, inside: float) -> list[tuple[float, int]]:
        """Cells by the probability that a neighbour at the reckoned distance lies there, the greatest
        first: its projection differs from the query's by a normal variable of that deviation."""
        scale = self.width / self.reach / sqrt(2)

        def between(step: int) -> float:
            return (erf((step + 1 - inside) * scale) - erf((step - inside) * scale)) / 2

        found, step = [(between(0), 0)], 1
        while max(up := between(step), down := between(-step)) > _UNLIKELY:
            found += [(up, step), (down, -step)]
            step += 1
        return sorted(found, reverse=True)


def in_order(steps: list[list[tuple[float, int]]], success: float) -> Iterator[tuple[int, ...]]:
    """Combinations of one (probability, step) of each list, by descending product, until products add up to ``success``."""
    logs = [[-log(max(p, 1e-300)) for p, _ in s] for s in steps]
    start = (0,) * len(steps)
    heap, reached = [(sum(x[0] for x in logs), start)], 0.0
    while heap and reached < success:
        cost, at = heapq.heappop(heap)
        reached += np.exp(-cost)
        yield tuple(s[i][1] for s, i in zip(steps, at))
        # each combination has one parent: the same with its last raised place lowered
        last = max((i for i, x in enumerate(at) if x), default=0)
        for i in range(last, len(at)):
            if at[i] + 1 < len(steps[i]):
                heapq.heappush(heap, (cost - logs[i][at[i]] + logs[i][at[i] + 1], (*at[:i], at[i] + 1, *at[i + 1 :])))


def takes_part(vector: Column) -> Column:
    """Not null, no component null or not finite, and not zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors in double precision, for each length of vectors there is."""
    lengths, flat = column.value_lengths().to_numpy(), column.flatten().to_numpy().astype(np.float64)
    ends = np.cumsum(lengths)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, flat[(ends[rows] - length)[:, None] + np.arange(length)]


def nearest(query: np.ndarray, rows: np.ndarray, squares: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` nearest rows and their distances, by distance and then id.

    A product of matrices tells who may be among them, as far as rounding goes; those are measured.
    """
    rough = squares - 2 * (rows @ query)
    near = np.arange(len(rows))
    if len(rows) > most and np.isfinite(rough).all():
        slack = 1e-9 * (np.abs(rough).max() + query @ query)
        near = np.flatnonzero(rough <= np.partition(rough, most - 1)[most - 1] + slack)
    apart = np.sqrt(((rows[near] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], apart))[:most]
    return near[order], apart[order]


def _measured(rows: DataFrame, queries: list[list[float]], most: int) -> DataFrame:
    """Exact distances of given queries to their ``most`` nearest of all rows, with sums over all rows:
    query, id, apart; and a row per task and query with total and n."""
    by_length: dict[int, list[int]] = {}
    for i, q in enumerate(queries):
        by_length.setdefault(len(q), []).append(i)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        total, n = np.zeros(len(queries)), np.zeros(len(queries), np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, vectors in _matrices(batch.column(1)):
                squares = (vectors**2).sum(axis=1)
                for q in by_length.get(vectors.shape[1], ()):
                    query = np.array(queries[q])
                    near, apart = nearest(query, vectors, squares, ids[at], most)
                    old = best.get(q, (np.empty(0, np.int64), np.empty(0)))
                    both = np.concatenate([old[0], ids[at][near]]), np.concatenate([old[1], apart])
                    order = np.lexsort(both)[:most]
                    best[q] = both[0][order], both[1][order]
                    total[q] += (squares - 2 * (vectors @ query) + query @ query).sum()
                    n[q] += len(at)
        for q, (near, apart) in best.items():
            size = len(near)
            yield pa.record_batch(
                [
                    pa.array([q] * (size + 1), pa.int32()),
                    pa.array([*near.tolist(), None], pa.int64()),
                    pa.array([*apart.tolist(), None], pa.float64()),
                    pa.array([None] * size + [total[q]], pa.float64()),
                    pa.array([None] * size + [int(n[q])], pa.int64()),
                ],
                names=["query", "id", "apart", "total", "n"],
            )

    return mapped(rows, measure, "query int, id long, apart double, total double, n long")


def fitted(rows: DataFrame, queries: DataFrame, most: int, sample: int = SAMPLE, tables: int = TABLES, bucket_rows: int = BUCKET_ROWS, success: float = SUCCESS) -> Hashing:
    """Hashing for rows and queries (vector) at hand, from the exact neighbours of ``sample`` queries."""
    chosen = [list(r[0]) for r in queries.select("vector").orderBy(F.xxhash64("vector")).limit(sample).collect()]
    seen = checkpointed(_measured(rows, chosen, most), narrow=True)
    whole = seen.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    near = first_rows(seen.filter("apart IS NOT NULL"), ["query"], [F.col("apart"), F.col("id")], most)
    last = sorted(r[0] for r in near.groupBy("query").agg(F.max("apart")).select("max(apart)").collect())
    spread = sqrt(max(0.0, (whole["total"] or 0.0) / max(1, whole["n"] or 0)) / 2)
    reach = last[ceil(SAMPLE_SHARE * len(last)) - 1] if last else 0.0
    if reach <= 0 or not np.isfinite(reach):  # all neighbours are copies
        reach = spread / 1000 if 0 < spread < float("inf") else 1.0
    return Hashing.of(rows.count(), reach, spread if np.isfinite(spread) else reach, tables, bucket_rows, success)


def _met(rows: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """query, id, apart: per query and bucket the ``most`` nearest of the bucket's rows.

    ``rows`` are (bucket, id, vector), ``queries`` (bucket, query, vector).  The rows of a full bucket are cut
    into parts, and so are its queries; each part of rows meets each part of queries in a task of its
    own, so a bucket may hold any share of the rows and be visited by any number of queries.
    """
    filled = rows.groupBy(F.col("bucket").alias("of")).agg(F.ceil(F.count(F.lit(1)) / MOST_ROWS).cast("int").alias("row_parts"))
    asked = queries.groupBy(F.col("bucket").alias("by")).agg(F.ceil(F.count(F.lit(1)) / MOST_QUERIES).cast("int").alias("query_parts"))
    grid = sized(checkpointed(filled.join(asked, F.col("of") == F.col("by")).drop("by"), narrow=True))

    def part(of: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(of), F.col(parts)).cast("int")

    def each(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = rows.join(grid, F.col("bucket") == F.col("of")).select(
        "bucket", part("id", "row_parts").alias("row_part"), each("query_parts").alias("query_part"), "id", "vector"
    )
    right = queries.join(grid, F.col("bucket") == F.col("of")).select(
        "bucket", each("row_parts").alias("row_part"), part("query", "query_parts").alias("query_part"), "query", "vector"
    )

    def meet(held: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if held.num_rows and asking.num_rows:
            ids, names = held.column("id").to_numpy(), asking.column("query").to_numpy()
            by_length = {m.shape[1]: (at, m) for at, m in _matrices(held.column("vector").combine_chunks())}
            for asked_at, asked_for in _matrices(asking.column("vector").combine_chunks()):
                if asked_for.shape[1] not in by_length:
                    continue
                at, vectors = by_length[asked_for.shape[1]]
                squares = (vectors**2).sum(axis=1)
                for name, query in zip(names[asked_at], asked_for):
                    near, apart = nearest(query, vectors, squares, ids[at], most)
                    out.append((np.full(len(near), name), ids[at][near], apart))
        columns = [np.concatenate(x) for x in zip(*out)] or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(columns, names=["query", "id", "apart"])

    keys = ["bucket", "row_part", "query_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query long, id long, apart double")


def neighbours(
    rows: DataFrame,
    queries: DataFrame,
    most: int = NEAREST,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    bucket_rows: int = BUCKET_ROWS,
    success: float = SUCCESS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest rows found of each query, by Euclidean distance.

    All rows are hashed into each table; a query visits the likeliest buckets of every table until a
    neighbour as far off as a last one is in them with probability ``success``, and what the tables yield is
    merged and ranked by exact distances in double precision, ties by smaller id.  A query that finds
    fewer than ``most`` is compared with all rows instead, so it gets all there are if they are fewer.

    Keys are whole numbers; rows and queries without a key, and vectors null, empty, zero or holding null or
    non-finite components, take no part.  Rows equal in key and vector are one row, and
    so are rows of one key that are equally far from a query; a query's own row is the one that equals it in both.  Vectors are compared with those of their own length.  Of equal vectors only
    the ``most`` + 1 smallest ids can matter, so no more are searched, and equal queries are
    searched once: copies may be any share of the table.  Empty tables give no rows; other columns are
    not read.
    """

    def valid(df: DataFrame) -> DataFrame:
        kind = dict(df.dtypes)[vector]
        own = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
        return df.select(F.col(key).cast("long").alias("id"), own.alias("vector")).filter(F.col("id").isNotNull() & takes_part(F.col("vector"))).distinct()

    kept = written(first_rows(valid(rows), ["vector"], [F.col("id")], most + 1).drop("rank"))
    asking = checkpointed(valid(queries))
    once = checkpointed(asking.select("vector").distinct().withColumn("query", F.monotonically_increasing_id()))
    hashing = fitted(kept, once, most + 1, tables=tables, bucket_rows=bucket_rows, success=success)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.empty((batch.num_rows, hashing.tables), np.int64)
            for at, vectors in _matrices(batch.column(1)):
                names[at] = hashing.buckets(vectors)
            offsets = pa.array(np.arange(0, names.size + 1, hashing.tables, dtype=np.int32))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(names.ravel()))], names=["id", "vector", "buckets"])

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                visits = list(dict.fromkeys(hashing.probes(np.array(own))))
                yield pa.record_batch([pa.array([name] * len(visits), pa.int64()), pa.array(visits, pa.int64())], names=["query", "bucket"])

    of_vector = dict(kept.dtypes)["vector"]
    index = written(mapped(kept, hashed, f"id long, vector {of_vector}, buckets array<long>")).select("id", "vector", F.explode("buckets").alias("bucket"))
    visits = checkpointed(mapped(once.select("vector", "query"), probing, "query long, bucket long"))
    occupied = index.select(F.col("bucket").alias("of")).distinct()
    visits = visits.join(occupied, F.col("bucket") == F.col("of"), "left_semi")
    found = checkpointed(_distinct(_met(index, visits.join(once, "query"), most + 1), most + 1, tables), narrow=True)

    enough = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    lacking = checkpointed(once.join(enough, "query", "left_anti"))
    if not lacking.isEmpty():
        scan = _met(kept.withColumn("bucket", F.lit(0).cast("long")), lacking.withColumn("bucket", F.lit(0).cast("long")), most + 1)
        found = found.join(lacking.select("query"), "query", "left_anti").unionByName(_distinct(scan, most + 1, 1))

    named = asking.join(once, "vector").select(F.col("id").alias("query_id"), "query")
    own = (F.col("query_id") == F.col("id")) & (F.col("apart") == 0)
    others = named.join(found, "query").filter(~own)
    ranked = first_rows(others, ["query_id", "query"], [F.col("apart"), F.col("id")], most)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("apart").alias("score"))


def _distinct(met: DataFrame, most: int, tables: int) -> DataFrame:
    """The ``most`` nearest of each query; a row may have been met in each table."""
    order = [F.col("apart"), F.col("id")]
    some = first_rows(met, ["query"], order, most * tables).drop("rank").distinct()
    return first_rows(some, ["query"], order, most).drop("rank")
