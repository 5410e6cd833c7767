"""Hierarchical residual packing: best fit within partitions, then rounds over what is left open."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from windrow.llm.shared import as_bytes, checkpointed, mapped
from windrow.llm.tokens import REMEMBERED, tokens_of

#: Tokens of a sequence.
CAPACITY = 2048
#: The id after the last of each document.
END_ID = 0
#: A bin with so little room left counts as full.
NEARLY = 8
#: Items that a task packs together, and the bytes with which these are taken to be enough.
AT_ONCE_ROWS, AT_ONCE_BYTES = 50_000, 16 << 20
#: Open rows that one task of a round takes.
ROUND_ROWS = 200_000
#: A round that closes or joins less than this share of the open bins is the last.
LEAST_GAIN = 0.01


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of each item: largest first, each into the fullest bin that has room."""
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0  # bit r of rooms: some bin has exactly r left
    for i, size in zip(order := np.argsort(-sizes, kind="stable").tolist(), sizes[order].tolist(), strict=True):
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, count = capacity, count, count + 1
        bins[i], places[i] = chosen, capacity - room
        if left := room - size:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins, places


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: key, piece, start, length, ids_crc32, and ids if asked for.

    A document's ids are the tokenizer's, without special tokens, and the end id.  Null is empty.
    Only a longer document is cut, and only its last piece is shorter.  ``remembered`` words are kept
    with their ids by each task, and as many older ones: some 500 bytes each.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    step, end = 4 * capacity, np.array([END_ID], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens_of(tokenizer, remembered)
        for batch in batches:
            at, starts, parts = [], [], []
            for i, data in enumerate(as_bytes(batch.column("text"))):
                ids = words.encode(data or b"") + end
                for start in range(0, len(ids), step):
                    at.append(i)
                    starts.append(start // 4)
                    parts.append(ids[start : start + step])
            lengths = np.array([len(p) // 4 for p in parts], np.int64)
            begins = np.array(starts, np.int64)
            columns = {
                "key": batch.column("key").take(pa.array(at)),
                "piece": pa.array((begins // capacity).astype(np.int32)),
                "start": pa.array(begins),
                "length": pa.array(lengths),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            }
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(parts), "<i4"))
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), flat)
            yield pa.record_batch(columns)

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(narrow, work, schema).withColumnRenamed("key", key)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches: best fit has more to choose from."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= AT_ONCE_ROWS or sum(b.nbytes for b in held) >= AT_ONCE_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def packed(items: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY) -> DataFrame:
    """``items`` with ``sequence_id``, ``offset`` and ``filled`` (tokens of the whole sequence).

    ``items`` has ``length``, from 1 to ``capacity``.  Each task packs what it reads, some
    batches at a time.  Bins with at most ``nearly`` left are done; all others go on as items of their own size:
    they are dealt anew to as many tasks as their rows need, and packed again, until one task has
    seen all that is open or a round gains almost nothing.  The bins left then are sequences too:
    no row is lost.  Columns of ``items`` under the new names are replaced; an empty table gives no
    rows.
    """
    items = items.drop("sequence_id", "offset", "filled")
    names = items.columns
    schema = items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "filled": F.lit(0).cast("long")}).schema

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33
        for batch in _gathered(batches):
            sizes = batch.column("length").to_numpy(zero_copy_only=False)
            bins, places = best_fit(sizes, capacity)
            filled = np.bincount(bins, sizes).astype(np.int64)
            columns = [batch.column(c) for c in names]
            yield pa.record_batch([*columns, pa.array(bins + made), pa.array(places), pa.array(filled[bins])], names=[*names, "sequence_id", "offset", "filled"])
            made += len(filled)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (parts := list(batches)):
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        old, at, row_bin = np.unique(rows.column("sequence_id").to_numpy(), return_index=True, return_inverse=True)
        sizes = rows.column("filled").to_numpy()[at]
        bins, places = best_fit(sizes, capacity)
        filled = np.bincount(bins, sizes).astype(np.int64)
        name = np.full(len(filled), np.iinfo(np.int64).max)
        np.minimum.at(name, bins, old)  # a joined bin is called after one of its own
        for column, values in (("sequence_id", name[bins]), ("offset", places), ("filled", filled[bins])):
            values = values[row_bin] + (rows.column("offset").to_numpy() if column == "offset" else 0)
            rows = rows.set_column(rows.schema.get_field_index(column), column, pa.array(values))
        yield from rows.to_batches()

    done = F.col("filled") >= capacity - nearly
    state = checkpointed(mapped(items, first, schema))
    whole, turn, bins_before = state.filter(done), 0, None
    while True:
        open_rows = state.filter(~done)
        rows, bins = open_rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("offset") == 0, 1))).first()
        if bins <= 1 or (bins_before and bins > bins_before * (1 - LEAST_GAIN)):
            return whole.unionByName(open_rows)
        tasks = -(-rows // ROUND_ROWS)
        dealt = open_rows.repartition(tasks, F.xxhash64("sequence_id", F.lit(turn)))
        state = checkpointed(mapped(dealt, again, schema), narrow=True)
        whole, turn, bins_before = whole.unionByName(state.filter(done)), turn + 1, bins
        if tasks == 1:
            return whole.unionByName(state.filter(~done))


def sequences(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The training rows: sequence_id, ids, and which pieces they came from, in order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "length", key, "piece", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces")
    )
