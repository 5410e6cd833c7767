"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from math import isqrt

import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from windrow.llm.mixing import HEAVY_ROWS, LEAST_RANGES, prefix_sums, tie_of
from windrow.llm.shared import checkpointed

#: Virtual nodes of each shard.
VIRTUAL_NODES = 64
#: Spans of the ring that are looked up, by the first three hexadecimal digits of a position.
SPANS = 1 << 12


@dataclass(frozen=True)
class Ring:
    """Arcs in clockwise order: where each ends, as an unsigned 64-bit position, and whose it is."""

    ends: tuple[int, ...]
    owners: tuple[int, ...]

    @staticmethod
    def of(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> Ring:
        """A shard's nodes depend on its own number only, so one more shard leaves the others' in place."""
        nodes = sorted((xxhash.xxh64_intdigest(f"{s}/{v}"), s) for s in range(shards) for v in range(virtual_nodes))
        return Ring(tuple(n for n, _ in nodes), tuple(s for _, s in nodes))

    def arc(self, position: int) -> int:
        """The first node at or after a position; after the last one the ring begins anew."""
        return bisect.bisect_left(self.ends, position) % len(self.ends)


@dataclass(frozen=True)
class Segment:
    """Rows ``first`` to ``first + n - 1`` of an arc go to a shard, into slots from ``slot`` on."""

    arc: int
    first: int
    n: int
    shard: int
    slot: int


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard.  Without slack these add up to the rows, so that every shard gets
    full and counts differ by one at most."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(-(-rows * (1 + slack) // shards))] * shards


def plan(ring: Ring, arc_rows: list[int], capacity: list[int]) -> list[Segment]:
    """Where the rows of each arc go.

    A shard first takes the rows of its own arcs, in clockwise order, until it is full.  What
    overflows goes on clockwise to the next shards that have room left.  The input is one count per
    virtual node, whatever the number of rows.
    """
    used = [0] * len(capacity)
    placed: list[Segment] = []

    def put(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, capacity[shard] - used[shard])
        if n > 0:
            placed.append(Segment(arc, first, n, shard, used[shard]))
            used[shard] += n
        return max(n, 0)

    over = []
    for arc, rows in enumerate(arc_rows):
        taken = put(arc, 0, rows, ring.owners[arc])
        if taken < rows:
            over.append((arc, taken, rows - taken))
    for arc, first, rows in over:
        for step in range(1, len(ring.owners)):
            if not rows:
                break
            taken = put(arc, first, rows, ring.owners[(arc + step) % len(ring.owners)])
            first, rows = first + taken, rows - taken
    return placed


def _arcs(ring: Ring, spark: SparkSession) -> DataFrame:
    """Per span of positions that share their leading bits: the first arc it meets, and the ends within it.

    One row for each of ``SPANS``, whatever the rows; so an arc is found by one look-up and few comparisons.
    """
    width = (1 << 64) // SPANS
    table = []
    for span in range(SPANS):
        first, past = bisect.bisect_left(ring.ends, span * width), bisect.bisect_left(ring.ends, (span + 1) * width)
        table.append((span, first, [f"{e:016X}" for e in ring.ends[first:past]]))
    return F.broadcast(spark.createDataFrame(table, "span int, first_arc int, inner_ends array<string>"))


def placed(rows: DataFrame, key: str, shards: int, virtual_nodes: int = VIRTUAL_NODES, slack: float = 0.0, tie: str | None = None) -> DataFrame:
    """``rows`` with ``home`` (the shard of the arc that the key hashes to), ``shard`` and ``slot``.

    Rows of an arc are numbered along it: by the hash of their key, then by ``tie``, a column of
    hash-random hexadecimal digits.  So what overflows is what lies last on its arc, however the rows are
    dealt over files.  Numbers are prefix sums over ranges of the ring; a key of any number of rows is cut by
    ties, and rows equal in both are alike.  The driver sees one count for each virtual node.  ``rows``
    should be narrow: they are written once and read again.  Null keys hash like any other value; an empty
    table gives no rows.
    """
    ring = Ring.of(shards, virtual_nodes)
    at = rows.withColumn("order_key", F.lpad(F.hex(F.xxhash64(key)), 16, "0"))
    at = at.withColumn("tie", F.lit("0" * 8) if tie is None else F.col(tie)).withColumn("size_of_row", F.lit(1).cast("long"))
    at = at.withColumn("span", F.conv(F.substring("order_key", 1, 3), 16, 10).cast("int")).join(_arcs(ring, rows.sparkSession), "span")
    arc = (F.col("first_arc") + F.size(F.filter("inner_ends", lambda e: e < F.col("order_key")))) % len(ring.ends)
    kept = [F.struct(*rows.columns).alias("row"), arc.alias("source"), "order_key", "tie", F.col("size_of_row").alias("size")]
    on_arcs = checkpointed(at.select(*kept))
    per_arc = [0] * len(ring.ends)
    for r in on_arcs.groupBy("source").count().collect():  # one row per virtual node at most
        per_arc[r["source"]] = r["count"]
    total = sum(per_arc)
    segments = plan(ring, per_arc, capacities(total, shards, slack))
    homes = [(s.arc, s.first, s.first + s.n, s.shard, s.slot, ring.owners[s.arc]) for s in segments]
    # at most one segment per arc, and one more for each shard that fills up on the way
    goes = rows.sparkSession.createDataFrame(homes, "seg_arc int, first long, past long, shard int, base long, home int")
    ranges = max(LEAST_RANGES, isqrt(total))
    numbered = prefix_sums(on_arcs, ranges, max(HEAVY_ROWS, total // ranges))
    rank = F.col("before")
    inside = (F.col("source") == F.col("seg_arc")) & (rank >= F.col("first")) & (rank < F.col("past"))
    return numbered.join(F.broadcast(goes), inside).select("row.*", "home", "shard", (F.col("base") + rank - F.col("first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slack: float = 0.0) -> DataFrame:
    """Per document: key, size (UTF-8 bytes and one), text_crc32, home, shard and slot (gapless from 0)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(key, (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), tie_of(text).alias("text_md5"))
    return placed(narrow, key, shards, slack=slack, tie="text_md5").drop("text_md5")
