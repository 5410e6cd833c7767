"""Connected components of a graph given as links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from windrow.llm.shared import checkpointed


def _least(links: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of itself and its partners."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """Per node that has a link: node, root (the smallest node that can be reached).

    ``links`` has columns ``u`` and ``v``, in any order.  Rounds alternate: each node hands the
    smallest node it knows to its larger partners, then to its smaller ones.  Components turn into
    stars around their smallest node in a number of rounds that grows as the logarithm of the graph.
    A hub is a minimum per task and then a skewed join, which Spark splits.
    """
    links = checkpointed(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), narrow=True)
    before = None
    while (state := _state(links)) != before:
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v")
        links = checkpointed(small.unionByName(least.filter("u <> least").select("u", F.col("least").alias("v"))).distinct(), narrow=True)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
