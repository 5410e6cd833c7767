"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from windrow.llm import quotient
from windrow.llm.shared import as_bytes, ascii_lower, checkpointed, mapped, sized, text_tag, without_rows

#: Fingerprints that a task counts before it emits their filters.
FLUSH = 1_000_000
#: Fingerprints that one merged block is meant to hold.
BLOCK_ROWS = 200_000
#: Tasks whose filters meet in one step of the tree of merges.
FAN = 4096
#: Block bits of the last step, at least: that many tasks merge.
LEAST_BITS = 6


def _normal(batch: pa.RecordBatch, text: str, bits: int) -> Iterator[tuple[bytes, int]]:
    """Normalised bytes and the fingerprint of each text, as a signed long."""
    for data in as_bytes(batch.column(text)):
        data = ascii_lower(data)
        yield data, (xxhash.xxh3_64_intdigest(data) >> (64 - bits) << (64 - bits)) - (1 << 63)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """Per row: row (any number, one each), key, tag, fingerprint and SHA-256 of the normalised text."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            normal = list(_normal(batch, "text", bits))
            yield pa.record_batch(
                {
                    "row": batch.column("row"),
                    "key": batch.column("key"),
                    "tag": batch.column("tag"),
                    "fingerprint": pa.array([f for _, f in normal], pa.int64()),
                    "sha256": pa.array([hashlib.sha256(d).hexdigest() for d, _ in normal], pa.string()),
                }
            )

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), text_tag(text).alias("tag"), F.col(text).cast("string").alias("text")
    )
    return mapped(narrow, work, f"row long, key {kind}, tag long, fingerprint long, sha256 string")


def repeated_fingerprints(digest: DataFrame, rows: int, fan: int = FAN) -> DataFrame:
    """Fingerprints that came more than once, with their counts, by merged counting quotient filters.

    Each task emits the filters of what it has read, one row per block of fingerprints.  Those of ``fan``
    tasks meet by block and are handed on, cut into finer blocks, until all tasks' have met: one
    step up to ``fan`` tasks, two up to its square.  What meets in a task is set by the number of
    blocks, not by how often a fingerprint comes: a text that a third of all rows share is one slot in
    each filter.
    """
    levels = quotient.tree(rows, digest.rdd.getNumPartitions(), BLOCK_ROWS, fan, LEAST_BITS)
    stored = "block int, share int, quotient_bits int, occupied binary, run_ends binary, remainders binary, counts binary"

    def emitted(share: int, bits: int, fingerprints: np.ndarray, counts: np.ndarray) -> pa.Table:
        found = [{"block": block, "share": share} | vars(kept) for block, kept in quotient.split(bits, fingerprints, counts)]
        return pa.Table.from_pylist(found, _arrow(stored))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []

        def flushed() -> list[pa.RecordBatch]:
            unique = np.unique(np.concatenate(parts), return_counts=True)
            return emitted(share // levels[0].fan, levels[0].bits, *unique).to_batches()

        for batch in batches:
            share = batch.column("task")[0].as_py()
            signed = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            parts.append(signed.view(np.uint64) ^ np.uint64(1 << 63))
            if sum(map(len, parts)) >= FLUSH:
                yield from flushed()
                parts = []
        if parts:
            yield from flushed()

    def merged(group: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
        names = ["quotient_bits", "occupied", "run_ends", "remainders", "counts"]
        return quotient.merge(bits, group.column("block")[0].as_py(), [quotient.Filter(**r) for r in group.select(names).to_pylist()])

    def handed_on(bits: int, level: quotient.Level) -> Callable[[pa.Table], pa.Table]:
        return lambda group: emitted(group.column("share")[0].as_py() // level.fan, level.bits, *merged(group, bits))

    def several(group: pa.Table) -> pa.Table:
        fingerprints, counts = merged(group, levels[-1].bits)
        often = counts > 1
        signed = (fingerprints[often] ^ np.uint64(1 << 63)).view(np.int64)
        return pa.table({"fingerprint": signed, "times": counts[often].astype(np.int64)})

    filters = mapped(digest.select("fingerprint", F.spark_partition_id().alias("task")), build, stored)
    for before, level in zip(levels, levels[1:], strict=False):
        filters = filters.groupBy("block", "share").applyInArrow(handed_on(before.bits, level), stored)
    return filters.groupBy("block").applyInArrow(several, "fingerprint long, times long")


def _arrow(columns: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def byte_classes(docs: DataFrame, repeated: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """Classes of equal bytes among the rows whose fingerprint came more than once.

    Copies collapse before the shuffle, so a class of any size is a row per task.  The SHA-256 only
    names a class on the way back to its rows; should it ever name two texts, the job fails.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            normal = list(_normal(batch, "text", bits))
            yield pa.record_batch(
                {
                    "key": batch.column("key"),
                    "tag": batch.column("tag"),
                    "fingerprint": pa.array([f for _, f in normal], pa.int64()),
                    "normal": pa.array([d for d, _ in normal], pa.binary()),
                }
            )

    narrow = docs.select(F.col(key).alias("key"), text_tag(text).alias("tag"), F.col(text).cast("string").alias("text"))
    routed = mapped(narrow, work, f"key {kind}, tag long, fingerprint long, normal binary")
    candidates = routed.join(sized(repeated.select("fingerprint")), "fingerprint")
    classes = (
        candidates.groupBy("fingerprint", "normal")
        .agg(F.max(F.struct("key", "tag")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .select("fingerprint", F.sha2("normal", 256).alias("sha256"), "keep", "group_size")
    )
    clash = F.raise_error(F.lit("two different texts of one SHA-256"))
    return classes.groupBy("fingerprint", "sha256").agg(
        F.when(F.count(F.lit(1)) > 1, clash).otherwise(F.max("keep")).alias("keep"), F.max("group_size").alias("group_size")
    )


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """Per row of ``docs``: key, tag, keep_id, group_size, kept, repeated, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts
    the row of the largest key stays, a null key being the smallest; of rows that also share
    their key, one stays (``repeated`` marks those that share key and text).  An empty table
    gives no rows; other columns are not read.
    """
    digest = checkpointed(digests(docs, key, text, bits))
    repeated = checkpointed(repeated_fingerprints(digest, digest.count()), narrow=True)
    classes = checkpointed(byte_classes(docs, repeated, key, text, bits), narrow=True)  # so that Spark may split a hot class in the join
    again = (
        digest.groupBy("key", "tag")
        .agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select(F.col("key").alias("again_key"), F.col("tag").alias("again_tag"), "first_row")
    )
    same = F.col("key").eqNullSafe(F.col("again_key")) & (F.col("tag") == F.col("again_tag"))
    rows = digest.join(classes, ["fingerprint", "sha256"], "left").join(again, same, "left")
    alone = F.col("keep").isNull()
    stays = alone | (F.col("key").eqNullSafe(F.col("keep.key")) & (F.col("tag") == F.col("keep.tag")))
    return rows.select(
        F.col("key").alias(key),
        "tag",
        F.when(alone, F.col("key")).otherwise(F.col("keep.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (stays & (F.col("first_row").isNull() | (F.col("row") == F.col("first_row")))).alias("kept"),
        F.col("first_row").isNotNull().alias("repeated"),
        F.col("sha256").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = checkpointed(duplicates(docs, key, text).select(key, "tag", "kept", "repeated"), narrow=True)
    gone = found.filter("not kept and not repeated")
    # of a repeated pair one row may stay; if none does, the whole pair goes
    several = found.filter("repeated").groupBy(key, "tag").agg(F.max("kept").alias("one_stays"))
    dropped = gone.select(key, "tag").unionByName(several.filter("not one_stays").select(key, "tag"))
    pairs = several.filter("one_stays").select(key, "tag")
    return without_rows(docs, checkpointed(dropped, narrow=True), checkpointed(pairs, narrow=True), key, text)
