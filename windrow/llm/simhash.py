"""SimHash near-duplicates, found by Golay-code fuzzy keys and pigeonhole over three segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from windrow.llm import golay
from windrow.llm.components import components
from windrow.llm.shared import as_bytes, ascii_lower, checkpointed, mapped, text_tag, without_rows

SHINGLE_WORDS = 4
#: The keys below are made for this many bits; a smaller distance may be asked for, not a larger one.
MOST_BITS = 4
SEED = 42
#: Where the segments begin, and their bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Shingles whose bits are counted at a time.
AT_ONCE = 1 << 16
#: Runs of a key up to this length compare all their pairs at once.
SHORT_RUN = 8


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is in over half of the shingles' hashes; without words the result is 0."""
    words = text.split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    last = max(len(words) - shingle_words, 0)
    ends = (starts + lengths)[-(last + 1) :]
    ones = np.zeros(64, np.int64)
    for at in range(0, last + 1, AT_ONCE):
        upto = min(at + AT_ONCE, last + 1)
        spans = zip(starts[at:upto].tolist(), ends[at:upto].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > last + 1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: key, tag, fingerprint (its 64 bits as a signed long)."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(ascii_lower(t), shingle_words) for t in as_bytes(batch.column("text"))]
            marks = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.record_batch({"key": batch.column("key"), "tag": batch.column("tag"), "fingerprint": marks})

    narrow = docs.select(F.col(key).alias("key"), text_tag(text).alias("tag"), F.col(text).cast("string").alias("text"))
    return mapped(narrow, work, f"key {kind}, tag long, fingerprint long")


def fuzzy_keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, and the place of the fingerprint that each belongs to.

    Two fingerprints at most four bits apart share a key.  Either some segment is equal in both:
    then of the other two, one differs in at most two bits or the other in at most one, so the equal
    segment with a fuzzy key of one of them is shared.  Or each segment differs in one bit, but for
    one that may differ in two: then three fuzzy keys together are shared.
    """
    cut = [((marks >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    fuzzy = [golay.keys(words, bits) for words, (_, bits) in zip(cut, SEGMENTS, strict=True)]
    wide = [(found.astype(np.int64), far, near) for found, far, near in fuzzy]
    keys, places = [], []
    for i, (j, k) in enumerate(((1, 2), (0, 2), (0, 1))):
        for segment, chosen in ((j, 1), (k, 2)):
            row, column = np.nonzero(wide[segment][chosen])
            kind = 3 * i + segment
            keys.append((np.int64(kind) << 40) | (cut[i][row] << 12) | wide[segment][0][row, column])
            places.append(row)
    per_row = []
    for found, far, near in wide:  # the marked entries first, so that a few columns hold them all
        order = np.argsort(~near * 2 - far, axis=1, kind="stable")[:, : max(1, int(far.sum(axis=1).max(initial=1)))]
        per_row.append([np.take_along_axis(x, order, axis=1) for x in (found, far, near)])
    for a in range(per_row[0][0].shape[1]):
        for b in range(per_row[1][0].shape[1]):
            for c in range(per_row[2][0].shape[1]):
                use = (per_row[0][1][:, a] & per_row[1][1][:, b] & per_row[2][1][:, c]) & (
                    per_row[0][2][:, a].astype(np.int8) + per_row[1][2][:, b] + per_row[2][2][:, c] >= 2
                )
                if len(row := np.flatnonzero(use)):
                    keys.append((np.int64(9) << 40) | (per_row[0][0][row, a] << 24) | (per_row[1][0][row, b] << 12) | per_row[2][0][row, c])
                    places.append(row)
    return np.concatenate(keys), np.concatenate(places)


def _run_links(marks: np.ndarray, most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links that connect what is connected among the distinct fingerprints of one key.

    Each fingerprint reached is compared with those not yet reached, so that a cluster of m near
    copies gives m - 1 links and not all its pairs.
    """
    left = marks
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= most_bits
            if near.any():
                reached = left[near]
                yield np.full(len(reached), one), reached
                front.extend(reached)
                left = left[~near]


def links(marks: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links u, v between distinct fingerprints (column ``fingerprint``) at most ``most_bits`` apart.

    Not all pairs are given, but enough that every two linked fingerprints are connected.
    """
    if most_bits > MOST_BITS:
        raise ValueError(f"at most {MOST_BITS} bits")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            keys, places = fuzzy_keys(values)
            yield pa.record_batch({"key": pa.array(keys), "fingerprint": pa.array(values[places].view(np.int64))})

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in (*batches, None):
            if batch is not None:
                held_keys = np.append(held_keys, batch.column("key").to_numpy(zero_copy_only=False))
                held = np.append(held, batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64))
                ready = np.searchsorted(held_keys, held_keys[-1])  # the last key may go on in the next batch
            else:
                ready = len(held)
            if found := _links_of(held_keys[:ready], held[:ready], most_bits):
                yield found
            held_keys, held = held_keys[ready:], held[ready:]

    keyed = mapped(marks.select("fingerprint"), emit, "key long, fingerprint long")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key")
    return mapped(sorted_keys, verify, "u long, v long").distinct()


def _links_of(keys: np.ndarray, marks: np.ndarray, most_bits: int) -> pa.RecordBatch | None:
    """The links of whole runs of keys; the keys are sorted."""
    if not len(keys):
        return None
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    run_size = np.repeat(sizes, sizes)
    us, vs = [], []
    short = run_size <= SHORT_RUN
    few_keys, few = keys[short], marks[short]
    for step in range(1, SHORT_RUN):
        a, b = few[:-step], few[step:]
        near = (few_keys[:-step] == few_keys[step:]) & (np.bitwise_count(a ^ b) <= most_bits)
        us.append(a[near])
        vs.append(b[near])
    for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        for u, v in _run_links(marks[start : start + size], most_bits):
            us.append(u)
            vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    if not len(u):
        return None
    pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
    return pa.record_batch({"u": pa.array(pairs[:, 0].copy().view(np.int64)), "v": pa.array(pairs[:, 1].copy().view(np.int64))})


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """Per row: key, tag, fingerprint (long), component (smallest key reachable), keep (its key and tag).

    Rows of one fingerprint count as linked, and are one node of the graph however many they are.
    Texts without words have fingerprint 0 and are linked like any other; null counts as empty.
    Null keys are passed over when the smallest is taken, unless a component has no other; then
    ``component`` is null.  Of rows that share the smallest key, ``keep`` is the one of the smallest
    tag.  An empty table gives no rows.
    """
    rows = checkpointed(fingerprints(docs, key, text, shingle_words))
    smallest = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tag"))
    nodes = checkpointed(rows.groupBy("fingerprint").agg(smallest.alias("first")), narrow=True)
    roots = components(links(nodes, most_bits)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    firsts = checkpointed(rooted.groupBy("root").agg(F.min("first").alias("keep")), narrow=True)  # so that a large component can be split below
    named = rooted.select("fingerprint", "root").join(firsts, "root").select("fingerprint", "keep")
    return rows.join(named, "fingerprint").select(
        F.col("key").alias(key), "tag", "fingerprint", F.col("keep.key").alias("component"), F.struct("keep.key", "keep.tag").alias("keep")
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    found = near_duplicates(docs, key, text, shingle_words, most_bits)
    own = F.col(key).eqNullSafe(F.col("keep.key")) & (F.col("tag") == F.col("keep.tag"))
    pairs = checkpointed(found.select(key, "tag", own.alias("stays")).groupBy(key, "tag").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("times")), narrow=True)
    return without_rows(docs, pairs.filter("not stays"), pairs.filter("stays and times > 1"), key, text)
