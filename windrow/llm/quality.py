"""Document quality from a linear-chain CRF over lines."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from windrow.llm import crf
from windrow.llm.shared import as_bytes, checkpointed, fresh, mapped

#: Labelled texts that the model is fitted on, at most, of each label; the first by a hash of their id.
SAMPLE_TEXTS = 1000
#: Lines of such a text that the weights are fitted on, at most, in runs spread over the whole text; what
#: turns shares into scores is fitted on all lines.
SAMPLE_LINES, RUN_LINES = 200, 10
FOLDS, HELD_OUT_FOLD = 4, 2
#: Least score of a good document.
LEAST_SCORE = 0.7


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning; null ids have the CRC of an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % FOLDS == HELD_OUT_FOLD


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", texts: int = SAMPLE_TEXTS) -> crf.Model:
    """The model of a bounded sample of the labelled documents that are not held out.

    Ids with several labels go by the largest.  The driver gets the line features of at most
    ``2 * texts`` documents of at most ``SAMPLE_LINES`` lines, and fits the weights; then the share of
    good length of each of these texts, by all its lines, and fits the scores to them.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    order = (F.xxhash64(key), key)
    chosen = [known.filter(F.col("label") == y).orderBy(*order).limit(texts).collect() for y in (0, 1)]
    wanted = docs.sparkSession.createDataFrame([(r[key], r["label"]) for some in chosen for r in some], known.schema)  # at most 2 * texts rows
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("text")).join(F.broadcast(wanted), key).select(F.col(key).cast("string").alias("key"), "text", "label")

    # rows that share an id are one sample, so the bound holds
    chosen_texts = checkpointed(narrow.groupBy("key", "label").agg(F.min("text").alias("text")), narrow=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in as_bytes(batch.column("text")):
                rows, lengths = crf.features(data or b"")
                some = spread_lines(len(rows), crc32(data or b""))
                found.append((rows[some].astype("<f4").tobytes(), lengths[some].astype("<f4").tobytes()))
            columns = {"key": batch.column("key"), "label": batch.column("label")}
            yield pa.record_batch(columns | {"rows": pa.array([r for r, _ in found], pa.binary()), "lengths": pa.array([n for _, n in found], pa.binary())})

    rows = sorted(mapped(chosen_texts, work, "key string, label int, rows binary, lengths binary").collect(), key=lambda r: r["key"])
    samples = [(np.frombuffer(r["rows"], "<f4").reshape(-1, crf.FEATURES).astype(float), np.frombuffer(r["lengths"], "<f4").astype(float)) for r in rows]
    model = crf.train(samples, [r["label"] for r in rows])
    if len({r["label"] for r in rows}) < 2:
        return model

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.share(data or b"") for data in as_bytes(batch.column("text"))]
            yield pa.record_batch({"key": batch.column("key"), "label": batch.column("label"), "share": pa.array(found, pa.float64())})

    whole = sorted(mapped(chosen_texts, shares, "key string, label int, share double").collect(), key=lambda r: r["key"])
    return crf.calibrated(model, [r["share"] for r in whole], [r["label"] for r in whole])


def spread_lines(n: int, seed: int) -> np.ndarray:
    """Places of at most ``SAMPLE_LINES`` of ``n`` lines, in order: whole runs, by a hash over the whole text."""
    if n <= SAMPLE_LINES:
        return np.arange(n)
    runs = (np.arange(-(-n // RUN_LINES), dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    chosen = np.sort(np.argsort(runs, kind="stable")[: SAMPLE_LINES // RUN_LINES])
    places = (chosen[:, None] * RUN_LINES + np.arange(RUN_LINES)).ravel()
    return places[places < n]


def scored(docs: DataFrame, model: crf.Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1.  Null and blank texts are scored as one blank line."""
    names = [c for c in docs.columns if c != score]
    columns = {f"c{i}": c for i, c in enumerate(names)}
    plain = docs.select(*(F.col(c).alias(n) for n, c in columns.items()), F.col(text).cast("string").alias("scored_text"))
    schema = plain.select(*columns, F.lit(0.0).alias("score")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(data or b"") for data in as_bytes(batch.column("scored_text"))]
            yield pa.record_batch([*(batch.column(c) for c in columns), pa.array(scores, pa.float64())], names=[*columns, "score"])

    return mapped(plain, work, schema).withColumnsRenamed(columns | {"score": score})


def rated(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per row of ``docs``: key, held_out, score, predicted.  An empty table gives no rows."""
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    found = scored(narrow, learn(docs, labels, key, text, label), "text")
    return found.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Without any label nothing is learnt, and nothing rejected.
    """
    model = learn(docs, labels, key, text, label)
    if not model.slope and not model.shift:
        return docs
    (score,) = fresh(docs, "score")
    return scored(docs, model, text, score).filter(F.col(score) >= LEAST_SCORE).select(*docs.columns)
