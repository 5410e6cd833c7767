"""Quality rules: distance of a document's histograms from those of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from windrow.llm.shared import as_bytes, checkpointed, mapped

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 20
WINDOW_WORDS = 8
MOST_REPEATED_PERCENT = 30

#: Words of a language that have a bar of their own in the word histogram; all others share one.
COMMON_WORDS = 200
#: Words that a language must have in the corpus to be a reference; documents of others are not judged by a histogram.
LEAST_REFERENCE_WORDS = 5_000
#: Shorter documents are not judged by a histogram: their own is too rough.
LEAST_CHARACTERS, LEAST_HISTOGRAM_WORDS = 200, 50
#: Jensen-Shannon distances (0 to 1) above which a document is too far from its language.
MOST_CHARACTER_DISTANCE, MOST_WORD_DISTANCE = 0.25, 0.53
#: Words counted before a task emits them.
FLUSH_WORDS = 500_000
#: The name of the reference made of all languages.
ANY = ""


def _classes() -> np.ndarray:
    """Class of each byte: small vowels and consonants, capitals, digits, white space, stops, other
    marks, symbols, and first bytes of characters beyond ASCII; the rest of these (the last class)
    does not count."""
    table = np.full(256, 6, np.uint8)
    for name, some in enumerate((b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(65, 91)), b"0123456789", b" \t\n\v\f\r", b".,", None, SYMBOLS)):
        if some:
            table[list(some)] = name
    table[0xC0:] = 8
    table[0x80:0xC0] = 9
    return table


CLASSES, N_CLASSES = _classes(), 9
#: Names under which the number of words and the classes are counted: no word has a line end.
WORDS_ITEM, CLASS_ITEMS = b"\n", [b"\n%d" % i for i in range(N_CLASSES)]


def character_counts(text: bytes) -> np.ndarray:
    return np.bincount(CLASSES[np.frombuffer(text, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (the square root of the divergence in bits) of each row's histogram."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / max(reference.sum(), 1)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = [np.where(x > 0, x * np.log2(x / middle), 0.0).sum(axis=1) for x in (p, np.broadcast_to(q, p.shape))]
    return np.sqrt(np.clip((apart[0] + apart[1]) / 2, 0, 1))


@dataclass
class Reference:
    """A language's character classes, its common words, and all its words."""

    classes: np.ndarray = field(default_factory=lambda: np.zeros(N_CLASSES))
    words: dict[bytes, int] = field(default_factory=dict)
    n_words: int = 0

    def histogram(self) -> np.ndarray:
        common = np.array([*self.words.values()], float)
        return np.append(common, self.n_words - common.sum())


def reference_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, item, n over every document: each word, the number of words, and each character class.

    Under ``ANY`` stand all documents together.  Words are counted by task and then shuffled once;
    both sums are taken where all counts of a word have met.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def emitted() -> Iterator[pa.RecordBatch]:
            for name, counter in words.items():
                counter.update(dict(zip(CLASS_ITEMS, classes[name].tolist(), strict=True)) | {WORDS_ITEM: counter.total()})
                items, counts = pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())
                yield pa.record_batch({"lang": pa.array([name] * len(counter), pa.string()), "item": items, "n": counts})
            words.clear()
            classes.clear()

        for batch in batches:
            for name, data in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
                if data:
                    words.setdefault(name, Counter()).update(data.split())
                    classes[name] = classes.get(name, 0) + character_counts(data)
                if sum(map(len, words.values())) > FLUSH_WORDS:
                    yield from emitted()
        yield from emitted()

    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(ANY)).alias("lang"), F.col(text).cast("string").alias("text"))
    met = mapped(narrow, work, "lang string, item binary, n long").repartition("item")
    own = met.groupBy("item", "lang").agg(F.sum("n").alias("n"))
    langs = F.filter(F.collect_list(F.struct("lang", "n")), lambda x: x["lang"] != ANY)
    both = own.groupBy("item").agg(F.array_append(langs, F.struct(F.lit(ANY).alias("lang"), F.sum("n").alias("n"))).alias("sums"))
    return both.select("item", F.inline("sums"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS, least_words: int = LEAST_REFERENCE_WORDS) -> dict[str, Reference]:
    """Per language with enough words its reference, and under ``ANY`` that of all documents.

    Only the classes, the totals and the ``common`` commonest words of such languages reach the
    driver; ties go by the word.
    """
    is_word = ~F.col("item").isin([WORDS_ITEM, *CLASS_ITEMS])
    place = F.row_number().over(Window.partitionBy("lang", is_word).orderBy(F.desc("n"), "item"))
    top = checkpointed(reference_counts(docs, text, lang).withColumn("place", place).filter(F.col("place") <= common))
    enough = top.filter((F.col("item") == F.lit(WORDS_ITEM)) & ((F.col("n") >= least_words) | (F.col("lang") == ANY))).select("lang")
    found: dict[str, Reference] = {ANY: Reference()}
    for r in top.join(enough, "lang").orderBy("lang", "place").collect():
        one, item = found.setdefault(r["lang"], Reference()), bytes(r["item"])
        if item == WORDS_ITEM:
            one.n_words = r["n"]
        elif item in CLASS_ITEMS:
            one.classes[CLASS_ITEMS.index(item)] = r["n"]
        else:
            one.words[item] = r["n"]
    return found


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of words found twice or more."""
    if len(words) <= window:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - window + 1
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    _, back, times = np.unique(rolled, return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(times[back] > 1)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def judged(docs: DataFrame, known: dict[str, Reference], key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row of ``docs``: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept.

    A distance is null where the text is too short for its histogram, or its language has no
    reference of its own; such a text is kept if it passes the base rules.  Null texts are empty;
    documents whose language is null are compared with all documents together.
    """
    kind = docs.schema[key].dataType.simpleString()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = f"key {kind}, " + ", ".join(f"{c} long" for c in counts) + ", char_distance double, word_distance double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {name: {w: i for i, w in enumerate(ref.words)} for name, ref in known.items()}
        for batch in batches:
            own_langs = batch.column("lang").to_pylist()
            rows, langs, alone = [], [x if x in known else ANY for x in own_langs], np.array([x not in known for x in own_langs])
            chars, words = np.zeros((batch.num_rows, N_CLASSES)), [np.zeros(0)] * batch.num_rows
            for i, data in enumerate(as_bytes(batch.column("text"))):
                data = data or b""
                own = data.split()
                chars[i] = character_counts(data)
                place, other = places[langs[i]], len(places[langs[i]])
                words[i] = np.bincount([place.get(w, other) for w in own], minlength=other + 1)
                points = len(data) - np.count_nonzero(CLASSES[np.frombuffer(data, np.uint8)] == N_CLASSES)
                rows.append((len(own), int(points - chars[i][4]), sum(map(data.count, (bytes([s]) for s in SYMBOLS))), repeated_lines(data), repeated_words(own)))
            numbers = np.array(rows, np.int64)
            char_far, word_far = np.zeros(len(rows)), np.zeros(len(rows))
            for name in set(langs):
                at = [i for i, x in enumerate(langs) if x == name]
                char_far[at] = distances(chars[at], known[name].classes)
                word_far[at] = distances(np.stack([words[i] for i in at]), known[name].histogram())
            columns = {"key": batch.column("key")} | {c: pa.array(numbers[:, i].copy()) for i, c in enumerate(counts)}
            columns["char_distance"] = pa.array(char_far, mask=alone | (chars.sum(axis=1) < LEAST_CHARACTERS))
            columns["word_distance"] = pa.array(word_far, mask=alone | (numbers[:, 0] < LEAST_HISTOGRAM_WORDS))
            yield pa.record_batch(columns)

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(ANY)).alias("lang"))
    found = mapped(narrow, work, schema).withColumnRenamed("key", key)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    far = (F.col("char_distance") > MOST_CHARACTER_DISTANCE) | (F.col("word_distance") > MOST_WORD_DISTANCE)
    return found.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def rated(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """:func:`judged` against the references of these documents themselves; an empty table gives no rows."""
    return judged(docs, references(docs, text, lang), key, text, lang)
