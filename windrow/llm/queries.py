"""One query per operator over the given tables, in the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from windrow.llm import exact, html, lexical, licenses, lm, mixing, neighbours, packing, quality, ring, rules, simhash, trie
from windrow.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.packed(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """The target is what is labelled good; the background is all documents."""
    good = table(spark, folder, "labels").filter("quality = 1")
    return lm.rated(table(spark, folder, "documents"), good)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shards 0 to 7 by the law of rows: without slack every shard gets full, so counts differ by one at most."""
    placed = ring.shard_documents(table(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard")
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rated(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op7_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rated(table(spark, folder, "documents"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mixed(docs, docs.count()).select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=4, most_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.labelled(table(spark, folder, "documents"))


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.trie(table(spark, folder, "conversations"))


def op13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_html": op6_html,
    "op7_rules": op7_rules,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_licenses": op10_licenses,
    "op11_search": op11_search,
    "op12_trie": op12_trie,
    "op13_neighbours": op13_neighbours,
}
