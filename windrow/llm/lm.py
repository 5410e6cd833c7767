"""Cross-entropy difference of two matched bigram models over all words of the corpus."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from windrow.llm.shared import as_bytes, mapped, sized, written

#: Tokens of the vocabulary: the edge of a document, shapes of unknown words, and words.  As many as
#: this means every word of the corpus; of fewer, the commonest words are taken.
VOCABULARY = 1 << 62
#: Weight of the word's own frequency against the counts of its pairs, in counts.
PRIOR = 10.0
#: Words counted, or remembered, before a task begins anew.
REMEMBERED = 300_000
#: Pairs of tokens that a task counts together before it emits them, and rows of what it emits.
FLUSH_PAIRS, ROWS = 500_000, 50_000
#: Tokens and pairs that are listed as common at most; pairs are looked for in one of so many documents.
COMMON, LOOKED_AT = 10_000, 64
#: Pairs and documents of a block, and entries of a token that go to one place, on average.
BLOCK_PAIRS, MOST_DOCS, MOST_ENTRIES = 1_200_000, 65_536, 250_000
#: Pairs that one task counts on average, entries that it scores at a time, places permitting, and shares that
#: it adds up at a time, and sums by document that it holds.
PART_PAIRS, SCORED, ADDED, HELD_SUMS = 16_000_000, 200_000, 600_000, 1_000_000
#: What an entry's number can tell; above it, the document is one of the target's.
MOST_TIMES = 32_767
ENTRY = np.dtype([("pair", "<i8"), ("doc", "<u2"), ("n", "<u2")])

EDGE = 0
#: What the first of two codes is multiplied by to make the pair's.
FIRST = np.int64(-7046029254386353131)
_MARKED, _DIGIT, _SYMBOL = re.compile(rb"[.,;:!?]\Z"), re.compile(rb"[0-9]"), re.compile(rb"[#*$%&|<>@=/_\\{}\[\]()+~^!]")
#: Shapes: length in three steps, capitals in three, digits, symbols, and a mark at the end.
SHAPES = 3 * 3 * 2 * 2 * 2


def shape(word: bytes) -> int:
    """What is seen of an unknown word, from 0 up to ``SHAPES``."""
    capitals = 2 if len(word) > 1 and word.upper() == word and word.lower() != word else word[:1].isupper()
    found = (len(word) > 4) + (len(word) > 9)
    for size, value in ((3, capitals), (2, bool(_DIGIT.search(word))), (2, bool(_SYMBOL.search(word))), (2, bool(_MARKED.search(word)))):
        found = found * size + value
    return found


class Codes(dict):
    """The 64-bit code of each word's token, remembered for a while.

    With ``known`` words, all others have their shape's code; without, each word is a token.  Codes
    are hashes: they need no table, however many words there are.
    """

    def __init__(self, known: list[bytes] | None):
        super().__init__()
        self.known = None if known is None else frozenset(known)

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        name = word if self.known is None or word in self.known else b"\n%d" % shape(word)  # no word has a line end
        code = self[word] = xxhash.xxh3_64_intdigest(name) - (1 << 63)
        return code

    def pairs(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of each pair of tokens in a row and of its second token, and pairs per text.

        A text begins and ends at the edge, so that one without words has one pair.
        """
        tokens, sizes = [EDGE], []
        for text in texts:
            words = (text or b"").split()
            tokens.extend(map(self.__getitem__, words))
            tokens.append(EDGE)
            sizes.append(len(words) + 1)
        flat = np.array(tokens, np.int64)
        return flat[:-1] * FIRST + flat[1:], flat[1:], np.array(sizes, np.int64)


def vocabulary(docs: DataFrame, text: str = "text", size: int = VOCABULARY) -> list[bytes]:
    """The commonest words of all documents, ties by the word; the driver gets no more than these."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            for data in as_bytes(batch.column("text")):
                counter.update((data or b"").split())
                if len(counter) > REMEMBERED:
                    yield _rows(counter)
                    counter.clear()
        yield _rows(counter)

    counts = mapped(docs.select(F.col(text).cast("string").alias("text")), work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size - 1 - SHAPES).collect()
    return [bytes(r["word"]) for r in top]


def _rows(counter: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(list(counter), pa.binary()), "n": pa.array(list(counter.values()), pa.int64())})


def _sliced(**columns: pa.Array | np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = pa.record_batch({name: pa.array(c) if isinstance(c, np.ndarray) else c for name, c in columns.items()})
    for at in range(0, whole.num_rows, ROWS):
        yield whole.slice(at, ROWS)


def pair_counts(docs: DataFrame, known: list[bytes] | None = None, text: str = "text", target: str = "target") -> DataFrame:
    """pair, token, n, n_target: how often each pair of tokens stands in all documents and in the
    target's, and the code of its second token."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held, size = Codes(known), [], 0

        def emitted() -> Iterator[pa.RecordBatch]:
            pairs, tokens, inside = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            found, first, back, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
            aimed = np.bincount(back[inside], minlength=len(found))
            yield from _sliced(pair=found, token=tokens[first], n=n, n_target=aimed)

        for batch in batches:
            pairs, tokens, sizes = codes.pairs(as_bytes(batch.column("text")))
            held.append((pairs, tokens, np.repeat(np.array(batch.column("target").to_pylist(), bool), sizes)))
            size += len(pairs)
            if size > FLUSH_PAIRS:
                yield from emitted()
                size = 0
        if held:
            yield from emitted()

    narrow = docs.select(F.col(text).cast("string").alias("text"), F.col(target).alias("target"))
    met = mapped(narrow, work, "pair long, token long, n long, n_target long").groupBy("pair", "token")
    return met.agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def losses(counts: np.ndarray, size: int, prior: float = PRIOR) -> np.ndarray:
    """Loss in nats of each second token after each first, from the counts of all pairs of a small vocabulary.

    A pair's probability leans on the second token's own frequency, as if it had come ``prior``
    times more; that frequency counts every token once more than seen.
    """
    pairs = counts.reshape(size, size).astype(np.float64)
    alone = (pairs.sum(axis=0) + 1) / (pairs.sum() + size)
    return -np.log((pairs + prior * alone) / (pairs.sum(axis=1, keepdims=True) + prior)).astype(np.float32).ravel()


@dataclass(frozen=True)
class Sums:
    """Number of different tokens, and how many stand in all documents and in the target's."""

    size: int
    n: int
    n_target: int

    def share(self, c: np.ndarray, t: np.ndarray, total: int, prior: float = PRIOR) -> np.ndarray:
        """A pair's share of a text's loss, see :func:`losses`, from its count and that of its second token.

        A text begins and ends at the edge, so each token is as often a pair's first as a pair's second:
        the first's count is taken with the pair that the token ends, and both counts are the second's.
        """
        return np.log(t + prior) - np.log(c + prior * ((t + 1.0) / (total + self.size)))


@dataclass
class Models:
    """Two models of one form: the background's from all documents, the target's from those marked."""

    #: The words that are tokens; all if None.
    known: list[bytes] | None
    docs: DataFrame
    text: str
    target: str
    sums: Sums
    #: Commonest tokens and, among pairs that end in one, commonest pairs, by code: counts in both.
    tokens: dict[int, tuple[int, int]]
    pairs: dict[int, tuple[int, int]]

    @cached_property
    def shares(self) -> DataFrame:
        """pair, target, background: the shares of every pair seen, as a table."""
        counts = pair_counts(self.docs, self.known, self.text, self.target)
        alone = counts.groupBy("token").agg(F.sum("n").alias("t"), F.sum("n_target").alias("t_target"))

        def share(c: str, t: str, total: int) -> Column:
            return F.log(F.col(t) + PRIOR) - F.log(F.col(c) + PRIOR * ((F.col(t) + 1) / F.lit(float(total + self.sums.size))))

        both = share("n_target", "t_target", self.sums.n_target).alias("target"), share("n", "t", self.sums.n).alias("background")
        return counts.join(alone, "token").select("pair", *both)


def fit(docs: DataFrame, text: str = "text", target: str = "target", size: int = VOCABULARY) -> Models:
    """Both models' sums, over every document, and the counts of what is commonest.

    The driver gets sums and two lists of ``COMMON`` rows at most, and the words only of a vocabulary of
    limited ``size``.  Which pairs are looked at as common ones is told from a part of the documents; it
    bears on where they are scored and not on how: counts are over all documents.
    """
    known = None if size >= VOCABULARY else vocabulary(docs, text, size)
    part = docs.filter(F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(LOOKED_AT)) == 0)
    asked = pair_counts(part, known, text, target).orderBy(F.desc("n"), "pair").limit(COMMON).select("pair", "token").collect()
    ends = {r["pair"]: r["token"] for r in asked}
    counted = written(_counts(docs, known, sorted(ends), text, target))
    tokens = counted.filter("kind = 0")
    seen = tokens.agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).first()
    common = {r["code"]: (r["n"], r["n_target"]) for r in tokens.orderBy(F.desc("n"), "code").limit(COMMON).collect()}
    pairs = {r["code"]: (r["n"], r["n_target"]) for r in counted.filter("kind = 1").collect() if ends[r["code"]] in common}
    size = 1 + SHAPES + (max(seen["size"] - 1, 0) if known is None else len(known))
    return Models(known, docs, text, target, Sums(size, seen["n"] or 0, seen["n_target"] or 0), common, pairs)


def _counts(docs: DataFrame, known: list[bytes] | None, asked: list[int], text: str, target: str) -> DataFrame:
    """kind, code, n, n_target: of each token (0), and of the pairs asked for (1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held, size, wanted = Codes(known), [], 0, np.array(asked, np.int64)

        def emitted() -> Iterator[pa.RecordBatch]:
            for kind, parts in enumerate(zip(*held, strict=True)):
                found, inside = (np.concatenate(x) for x in zip(*parts, strict=True))
                if not len(found):
                    continue
                code, back, n = np.unique(found, return_inverse=True, return_counts=True)
                aimed = np.bincount(back[inside], minlength=len(code))
                yield from _sliced(kind=np.full(len(code), kind, np.int32), code=code, n=n, n_target=aimed)
            held.clear()

        for batch in batches:
            pairs, tokens, sizes = codes.pairs(as_bytes(batch.column("text")))
            inside = np.repeat(np.array(batch.column("target").to_pylist(), bool), sizes)
            some = _places(wanted, pairs) >= 0
            held.append(((tokens, inside), (pairs[some], inside[some])))
            size += len(pairs)
            if size > FLUSH_PAIRS:
                yield from emitted()
                size = 0
        if held:
            yield from emitted()

    narrow = docs.select(F.col(text).cast("string").alias("text"), F.col(target).alias("target"))
    met = mapped(narrow, work, "kind int, code long, n long, n_target long").groupBy("kind", "code")
    return met.agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def _places(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value stands in an ordered array; -1 if it is not there."""
    if not len(ordered):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


@dataclass
class _Common:
    """A list of counts by code, as ordered arrays."""

    codes: np.ndarray
    n: np.ndarray
    n_target: np.ndarray

    @staticmethod
    def of(counts: dict[int, tuple[int, int]]) -> _Common:
        codes = np.array(sorted(counts), np.int64)
        both = np.array([counts[c] for c in codes.tolist()], np.int64).reshape(-1, 2)
        return _Common(codes, both[:, 0], both[:, 1])


def _entries(docs: DataFrame, models: Models, key: str) -> DataFrame:
    """What is sent to where pairs are counted: rows (at, t, t_target, block, entries, key, n, target, background).

    A block is the documents that a task holds at a time.  Of each block and second token there is one row with
    its entries: pair, document of the block, number, and whether that is of the target's.  A token with
    many pairs has several places, by pair, and takes its counts along, which are null for others.  Common
    pairs are scored here.  Further rows tell of each document its key, its number of tokens and these
    sums; they have a document's number in ``at``.
    """
    text, target = models.text, models.target
    kind = docs.schema[key].dataType.simpleString()
    known, whole, tokens, pairs = models.known, models.sums, _Common.of(models.tokens), _Common.of(models.pairs)
    places = np.maximum(1, -(-tokens.n // MOST_ENTRIES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, block = Codes(known), TaskContext.get().partitionId() << 32
        ends = {c: i for i, c in enumerate(tokens.codes.tolist())}
        held: list[tuple] = []
        size = rows = 0

        def emitted() -> Iterator[pa.RecordBatch]:
            pair, second, sizes, inside = (np.concatenate(x) for x in list(zip(*held, strict=True))[:4])
            keys = pa.chunked_array([h[4] for h in held]).combine_chunks()
            held.clear()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((doc, pair))
            pair, second, doc = pair[order], second[order], doc[order]
            first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])))
            n = np.diff(np.append(first, len(pair)))
            pair, second, doc = pair[first], second[first], doc[first]
            at = _places(pairs.codes, pair)
            there = at >= 0
            sums = []
            for c, t, total in ((pairs.n_target, tokens.n_target, whole.n_target), (pairs.n, tokens.n, whole.n)):
                end = np.array([ends[x] for x in second[there].tolist()], np.int64)
                share = whole.share(c[at[there]], t[end], total) * n[there]
                sums.append(np.bincount(doc[there], weights=share, minlength=len(sizes)).astype(np.float64))
            yield from _sliced(
                at=np.arange(len(sizes)),
                t=pa.nulls(len(sizes), pa.int64()),
                t_target=pa.nulls(len(sizes), pa.int64()),
                block=np.full(len(sizes), block),
                entries=pa.nulls(len(sizes), pa.binary()),
                key=keys,
                n=sizes,
                target=sums[0],
                background=sums[1],
            )
            pair, second, doc, n = (x[~there] for x in (pair, second, doc, n))
            times = -(-n // MOST_TIMES)  # a pair that is in a document more often than an entry can tell has several
            if len(times) and times.max() > 1:
                last = n - (times - 1) * MOST_TIMES
                pair, second, doc = (np.repeat(x, times) for x in (pair, second, doc))
                more = np.full(len(pair), MOST_TIMES)
                more[np.cumsum(times) - 1] = last
                n = more
            common = _places(tokens.codes, second)
            place = np.where(common >= 0, (pair.view(np.uint64) >> np.uint64(20)).astype(np.int64) % places[common] if len(places) else 0, 0)
            order = np.lexsort((pair, place, second))
            pair, second, doc, n, common, place = (x[order] for x in (pair, second, doc, n, common, place))
            new = np.flatnonzero(np.append(True, (second[1:] != second[:-1]) | (place[1:] != place[:-1]))) if len(pair) else np.empty(0, np.int64)
            packed = np.empty(len(pair), ENTRY)
            packed["pair"], packed["doc"], packed["n"] = pair, doc, n + inside[doc] * (MOST_TIMES + 1)
            offsets = pa.array(np.append(new, len(pair)) * ENTRY.itemsize, pa.int32())
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(new), [None, offsets.buffers()[1], pa.py_buffer(packed.tobytes())])
            own, none = common[new], len(new)
            with_counts = own >= 0
            given = [pa.array(c[own] if len(c) else np.zeros(none, np.int64), pa.int64(), mask=~with_counts) for c in (tokens.n, tokens.n_target)]
            yield from _sliced(
                at=second[new] + place[new] * FIRST,
                t=given[0],
                t_target=given[1],
                block=np.full(none, block),
                entries=blobs,
                key=pa.nulls(none, keys.type),
                n=pa.nulls(none, pa.int64()),
                target=pa.nulls(none, pa.float64()),
                background=pa.nulls(none, pa.float64()),
            )

        for batch in batches:
            pair, second, sizes = codes.pairs(as_bytes(batch.column("text")))
            held.append((pair, second, sizes, np.array(batch.column("target").to_pylist(), bool), batch.column("key")))
            size, rows = size + len(pair), rows + batch.num_rows
            if size > BLOCK_PAIRS or rows > MOST_DOCS - batch.num_rows:
                yield from emitted()
                size, rows, block = 0, 0, block + 1
        if held:
            yield from emitted()

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(target).alias("target"))
    schema = f"at long, t long, t_target long, block long, entries binary, key {kind}, n long, target double, background double"
    return mapped(narrow, work, schema)


def _met(entries: DataFrame, whole: Sums, kind: str, parts: int) -> DataFrame:
    """block, doc, key, n, target, background: sums of shares by document, and the rows that tell of documents.

    Rows of one place come one after the other.  All entries of a pair, and unless its counts came along all of
    a token, are in one place; so they are counted, scored, and summed by document.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size, left = 0, None

        def merged() -> tuple[np.ndarray, ...]:
            block, doc, target, background = (np.concatenate(x) for x in zip(*sums, strict=True))
            order = np.lexsort((doc, block))
            block, doc = block[order], doc[order]
            new = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (doc[1:] != doc[:-1])))
            return block[new], doc[new], np.add.reduceat(target[order], new), np.add.reduceat(background[order], new)

        def out() -> Iterator[pa.RecordBatch]:
            block, doc, target, background = sums[0]
            none = len(block)
            yield from _sliced(block=block, doc=doc, key=pa.nulls(none, key_type), n=pa.nulls(none, pa.int64()), target=target, background=background)

        def score(rows: pa.RecordBatch) -> None:
            lengths = pc.binary_length(rows.column("entries")).to_numpy()
            entry = np.frombuffer(b"".join(rows.column("entries").to_pylist()), ENTRY)
            row = np.repeat(np.arange(rows.num_rows), lengths // ENTRY.itemsize)
            place = rows.column("at").to_numpy()
            group = np.append(0, np.cumsum(place[1:] != place[:-1]))
            which = group[row]
            aimed = entry["n"] > MOST_TIMES
            n = np.where(aimed, entry["n"].astype(np.int64) - (MOST_TIMES + 1), entry["n"])
            order = np.lexsort((entry["pair"], which))
            pair, of = entry["pair"][order], which[order]
            new = np.append(True, (pair[1:] != pair[:-1]) | (of[1:] != of[:-1]))
            back = np.cumsum(new) - 1
            first = np.flatnonzero(group != np.append(-1, group[:-1]))
            shares = []
            for counted, given, total in ((n * aimed, "t_target", whole.n_target), (n, "t", whole.n)):
                c = np.add.reduceat(counted[order], np.flatnonzero(new))
                own = np.bincount(which, weights=counted, minlength=len(first))
                t = rows.column(given).take(pa.array(first))
                t = np.where(t.is_null().to_numpy(zero_copy_only=False), own, t.fill_null(0).to_numpy())
                share = whole.share(c, t[of[new]], total)
                shares.append(share[back] * n[order])
            block = rows.column("block").to_numpy()[row][order]
            sums.append((block, entry["doc"][order].astype(np.int32), *shares))

        for batch in batches:
            told = pc.is_null(batch.column("entries"))
            if pc.any(told).as_py():
                rows = batch.filter(told)
                yield from _sliced(
                    block=rows.column("block"), doc=rows.column("at").cast(pa.int32()), key=rows.column("key"), n=rows.column("n"), target=rows.column("target"), background=rows.column("background")
                )
                batch = batch.filter(pc.invert(told))
            batch = batch.select(["at", "t", "t_target", "block", "entries"])
            if left is not None:
                batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0] if batch.num_rows else left
            if not batch.num_rows:
                continue
            at = batch.column("at").to_numpy()
            ended = int(np.searchsorted(at, at[-1]))  # the last place may go on
            left = batch.slice(ended)
            upto = np.cumsum(pc.binary_length(batch.column("entries")).to_numpy() // ENTRY.itemsize)
            begin = 0
            while begin < ended:
                past = int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + SCORED, side="right"))
                past = int(np.searchsorted(at, at[max(past, begin)])) if past < ended else ended
                if past <= begin:  # the place itself is that long
                    past = int(np.searchsorted(at, at[begin], side="right"))
                score(batch.slice(begin, past - begin))
                size, begin = size + len(sums[-1][0]), past
                if size > ADDED:
                    sums[:], size = [merged()], 0
                    if len(sums[0][0]) > HELD_SUMS:
                        yield from out()
                        sums.clear()
        if left is not None and left.num_rows:
            score(left)
        if sums:
            sums[:] = [merged()]
            yield from out()

    key_type = to_arrow_type(StructType.fromDDL(f"key {kind}")[0].dataType)
    dealt = entries.repartition(parts, "at").sortWithinPartitions("at")
    return mapped(dealt, work, f"block long, doc int, key {kind}, n long, target double, background double")


def rated(docs: DataFrame, chosen: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_tokens, target_loss, background_loss, score.

    The target is made of the documents whose key is in ``chosen``, the background of all.  Losses are
    means per token in nats; the score is the mean of the tokens' differences, target less background: the
    lower, the more like the target.  The end of a text counts as a token, so that empty and null texts have
    a score too.  Repeated rows are documents of their own.  With an empty target, or no documents, the
    target model is its prior alone.  An empty table gives no rows; other columns are not read.

    Each document's pairs are shuffled once, to where they are counted; only sums by document go on.
    """
    ids = sized(chosen.select(F.col(key).alias("chosen_key")).filter("chosen_key is not null").distinct())
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    marked = narrow.join(ids, F.col("key") == F.col("chosen_key"), "left").select("key", "text", F.col("chosen_key").isNotNull().alias("target"))
    models = fit(marked, "text", "target")
    parts = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-models.sums.n // PART_PAIRS))
    met = _met(_entries(marked, models, "key"), models.sums, marked.schema["key"].dataType.simpleString(), parts)
    summed = met.groupBy("block", "doc").agg(F.max("key").alias("key"), F.max("n").alias("n"), F.sum("target").alias("target"), F.sum("background").alias("background"))
    losses = [(F.col(c) / F.col("n")).alias(f"{c}_loss") for c in ("target", "background")]
    return summed.select(F.col("key").alias(key), F.col("n").alias("n_tokens"), *losses).withColumn("score", F.col("target_loss") - F.col("background_loss"))
