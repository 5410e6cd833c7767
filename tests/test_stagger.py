from datetime import datetime

import pytest
from pyspark.sql import functions as F

from windrow.operators import heavy
from windrow.operators.stagger import staggered


@pytest.mark.parametrize("above, limit", [(0, 1), (0, 3), (0, 10_000), (10_000, 10_000)])
def test_phase_is_the_keys_first_arrival(spark, monkeypatch, above, limit):
    monkeypatch.setattr(heavy.heaviest, "__defaults__", (above, limit))
    df = spark.range(3_000).selectExpr(
        "if(id % 3 = 0, 1, id % 50 + 2) k",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, 60 + pmod(hash(id), 5000) / 7) ts",
    )
    got = staggered(df, "10 seconds", "k").select(
        "k", "ts", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
    ).toPandas()
    assert len(got) == 3_000
    us = (got.ts - datetime(1970, 1, 1)).dt.total_seconds().mul(1e6).round().astype("int64")
    phase = us.groupby(got.k).transform("min") % 10_000_000
    start = us - (us - phase) % 10_000_000
    assert (((got.window_start - datetime(1970, 1, 1)).dt.total_seconds() * 1e6).round().astype("int64") == start).all()
    assert ((got.window_end - got.window_start).dt.total_seconds() == 10).all()


def test_hot_key_does_not_meet_in_one_join_task(spark, monkeypatch):
    monkeypatch.setattr(heavy.heaviest, "__defaults__", (0, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(30_000).selectExpr(
            "if(id % 3 = 0, 1, id) k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) ts"
        )
        joined = staggered(df, "10 seconds", "k").withColumn("task", F.spark_partition_id())
        plan = joined._jdf.queryExecution().executedPlan().toString()
        hot = plan.split("Union")[1].split("SortMergeJoin")[0]  # the branch of the hot key's rows
        assert "BroadcastHashJoin" in hot and "Exchange hashpartitioning" not in hot.split("BroadcastExchange")[0]
        per_task = joined.groupBy("task").agg(
            F.count_if(F.col("k") == 1).alias("hot"), F.min("window")
        ).collect()
        assert sum(r.hot for r in per_task) == 10_001
        assert max(r.hot for r in per_task) < 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("above, limit", [(0, 1), (10_000, 10_000)])
def test_rows_without_a_key_are_one_key(spark, monkeypatch, above, limit):
    monkeypatch.setattr(heavy.heaviest, "__defaults__", (above, limit))
    df = spark.range(100).selectExpr("if(id % 2 = 0, null, id % 3) k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id + 3) ts")
    got = staggered(df, "10 seconds", "k").collect()
    assert len(got) == 100 and all(r.window.start <= r.ts < r.window.end for r in got)
    assert {r.window.start.second % 10 for r in got if r.k is None} == {3}
