"""From raw documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from windrow.llm import exact, mixing, packing, quality, simhash
from windrow.llm.shared import checkpointed, new_folder, table
from windrow.session import remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The tokenizer of the packed sequences, one of the public files.
TOKENIZER = "word_bpe_49k.json"
#: Words that a task remembers the ids of: fewer than in the query of its own, since here the executors
#: also hold what earlier stages have left.
REMEMBERED_WORDS = 80_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from ``labels``; without any, all stay."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the document of the largest id stays."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by SimHash, the one of the smallest id stays."""
    return simhash.deduplicated(docs, shingle_words=4, most_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents up to its target, whole, and again where the target is larger."""
    return mixing.mixed_documents(docs, docs.count())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER), with_ids=False, remembered=REMEMBERED_WORDS)
    # written first: else tokenizing and packing would hold two Python workers for each core
    return packing.packed(checkpointed(pieces)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The classifier, the fingerprints and the tokenizer cannot be put in SQL: tests/llm holds the
#: stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each stage's rows are written to the shared folder, so that a
    later one, or a lost executor, reads them again and does not make them again.  A stage's table is
    removed when what the next one makes of it is written: no more than two copies of the corpus are there.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        folder = new_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        if read:
            remove_folder(spark, read)
        docs, read = spark.read.parquet(folder), folder
    packed = checkpointed(STAGES[-1][1](spark, docs, sf_dir))  # narrow rows
    remove_folder(spark, read)
    return packed
