"""Ranked lexical search: documents grouped by which of an item's terms they hold, best masks first."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from windrow.llm.shared import as_bytes, first_rows, mapped, written

#: Documents of an item.
TOP = 20
#: Items are searched in blocks of so many different terms; an item of more terms is a block of its own.
BLOCK_TERMS = 8192
#: Documents times terms that a task holds at a time.
CELLS = 1 << 22
#: Documents scored at a time: whole masks, and one at least.
STEP = 64

#: Only A-Z change; ASCII characters that are neither letters nor digits part terms.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    return [] if data is None else data.translate(_PLAIN).split()


@dataclass
class Block:
    """Items by key with their terms and how often each holds them, and the terms' places in a row."""

    items: list[tuple[int | None, Counter[bytes]]]
    place: dict[bytes, int]


def blocks(items: DataFrame, key: str, text: str, most: int) -> Iterator[Block]:
    """The items in blocks of at most ``most`` different terms, in the order of their keys.

    They are the stated queries: the driver holds one block at a time.  Rows equal in key and text
    count once, other rows of a key are one item.
    """
    held = Block([], {})
    rows = items.select(F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))).distinct().orderBy(key)
    last: tuple[int | None, Counter[bytes]] | None = None

    def put(item: tuple[int | None, Counter[bytes]]) -> Iterator[Block]:
        nonlocal held
        if held.items and len(held.place.keys() | item[1].keys()) > most:
            yield held
            held = Block([], {})
        held.items.append(item)
        for term in item[1]:
            held.place.setdefault(term, len(held.place))

    for row_key, body in rows.toLocalIterator():
        found = Counter(terms_of(body.encode()))
        if last is not None and last[0] == row_key:
            last[1].update(found)
            continue
        if last is not None:
            yield from put(last)
        last = (row_key, found)
    if last is not None:
        yield from put(last)
        yield held


def occurrences(docs: DataFrame, place: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Per document that has a term: key, n, and the given terms in it with how often it holds them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, starts, terms, counts = [], [], [0], [], []
            for row, body in enumerate(as_bytes(batch.column(1))):
                if not (words := terms_of(body)):
                    continue
                for term, n in Counter(words).items():
                    if (at := place.get(term)) is not None:
                        terms.append(at)
                        counts.append(n)
                rows.append(row)
                lengths.append(len(words))
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["doc", "n", "terms", "counts"],
            )

    narrow = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))
    return mapped(narrow, count, "doc long, n long, terms array<int>, counts array<int>")


@dataclass
class Best:
    """The best documents that a task has met for an item: scores, keys, and which keys are null."""

    scores: np.ndarray
    keys: np.ndarray
    null: np.ndarray

    def add(self, scores: np.ndarray, keys: np.ndarray, null: np.ndarray, top: int) -> None:
        some = scores > 0
        joined = (np.concatenate(x) for x in ((self.scores, scores[some]), (self.keys, keys[some]), (self.null, null[some])))
        self.scores, self.keys, self.null = joined
        order = np.lexsort((self.keys, self.null, -self.scores))[:top]
        self.scores, self.keys, self.null = self.scores[order], self.keys[order], self.null[order]

    def least(self, top: int) -> int:
        """What a document must score to matter: as much as the last of a full list, which a smaller key may beat."""
        return max(1, int(self.scores[-1])) if len(self.scores) == top else 1


def by_mask(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks and each document's mask, of a bitmap of documents per term.

    The bitmaps are turned into one bit string per document, whose distinct values are the groups.
    """
    terms, docs = present.shape
    words = -(-terms // 64)
    packed = np.zeros((8 * words, docs), np.uint8)
    packed[: -(-terms // 8)] = np.packbits(present, axis=0)
    strings = np.ascontiguousarray(packed.T)
    kind = np.uint64 if words == 1 else np.dtype((np.void, 8 * words))
    masks, group = np.unique(strings.view(kind)[:, 0], return_inverse=True)
    bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), 8 * words), axis=1)[:, :terms]
    return bits, group


def search(present: np.ndarray, impact: np.ndarray, weight: np.ndarray, keys: np.ndarray, null: np.ndarray, best: Best, top: int) -> int:
    """Adds an item's documents to ``best``; returns how many of them were scored.

    ``present`` and ``impact`` have a row for each of the item's terms.  A mask's greatest score is
    the sum of its terms' weights times the greatest impact that any document here has of each;
    masks go by that in descending order, and once it is under what counts, so are all that follow.
    """
    bits, group = by_mask(present)
    bound = bits.astype(np.int64) @ (impact.max(axis=1) * weight)
    order = np.argsort(-bound, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    docs = np.argsort(rank[group], kind="stable")
    ends = np.cumsum(np.bincount(rank[group], minlength=len(order)))
    done = mask = 0
    while mask < len(order) and bound[order[mask]] >= best.least(top):
        past = int(np.searchsorted(ends, done + STEP, side="right"))  # the masks that a step holds, one at least
        past = max(mask + 1, min(past, int(np.searchsorted(-bound[order], -best.least(top), side="right"))))
        part = docs[done : ends[past - 1]]
        best.add(weight @ impact[:, part], keys[part], null[part], top)
        done, mask = int(ends[past - 1]), past
    return done


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """Per item its ``top`` documents of score above 0: item_id, rank (from 1), doc_id, score.

    Terms are runs of letters, digits and other than ASCII characters of the whole text, A-Z
    lower-cased; the score is a weighted sum of saturated frequencies in whole numbers, weights and
    lengths taken over all documents.  Nothing is left out: a mask is passed over only where its
    greatest score cannot reach the list.

    Keys are whole numbers.  Equal scores go by ascending key, null keys last; each row of ``docs`` is
    a document, so repeated rows are listed as often as they stand there.  Null and empty texts have no
    terms: such documents count for nothing, such items have no rows.  Rows equal in item key and text
    are one; different texts of one item key, null included, are one item with the terms of all.  An
    empty table on either side gives no rows.  Other columns are not read.
    """
    out = None
    for block in blocks(items, item_key, item_text, block_terms):
        found = _block(docs, block, top, key, text)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def _block(docs: DataFrame, block: Block, top: int, key: str, text: str) -> DataFrame:
    seen = written(occurrences(docs, block.place, key, text))
    total = seen.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    weights = np.zeros(max(1, len(block.place)), np.int64)
    for r in seen.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the block
        weights[r["term"]] = floor(1000 * log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    items = []
    for item, found in block.items:
        if found:
            cols = np.array([block.place[t] for t in found], np.int64)
            items.append((item, cols, weights[cols] * np.array(list(found.values()), np.int64)))
    rows_at_a_time = max(1, CELLS // len(weights))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        held = [Best(none, none, none.astype(bool)) for _ in items]
        for whole in batches:
            for start in range(0, whole.num_rows, rows_at_a_time):
                batch = whole.slice(start, rows_at_a_time)
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                keys = batch.column(0).fill_null(0).to_numpy()
                length = 75 + 25 * batch.column(1).to_numpy() * n_docs // n_terms
                at = batch.column(2).flatten().to_numpy()
                times = batch.column(3).flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(keys)), batch.column(2).value_lengths().to_numpy())
                present = np.zeros((len(weights), len(keys)), bool)
                present[at, doc] = True
                impact = np.zeros((len(weights), len(keys)), np.int32)
                impact[at, doc] = 1_000_000_000 * times // (1000 * times + 12 * length[doc])
                for best, (_, cols, weight) in zip(held, items):
                    search(present[cols], impact[cols].astype(np.int64), weight, keys, null, best, top)
        for best, (item, _, _) in zip(held, items):
            if len(best.scores):
                same = pa.array([item] * len(best.scores), pa.int64())
                yield pa.record_batch([same, pa.array(best.keys, mask=best.null), pa.array(best.scores)], names=["item_id", "doc_id", "score"])

    found = mapped(seen, find, "item_id long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return first_rows(found, ["item_id"], order, top).select("item_id", "rank", "doc_id", "score")
