from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from windrow.functions.durations import common_pane, micros
from windrow.operators.totals import amount_totals, windowed_aggregates, windowed_sums
from windrow.operators.windows import RETAIL_WINDOWS, WORD_WINDOWS, Windows
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)


def at(seconds):
    return EPOCH + timedelta(seconds=seconds)


def bounds(spark, windows, seconds):
    df = spark.createDataFrame([(at(seconds),)], "ts timestamp_ntz")
    got = df.select(windows.of("ts").alias("w")).select("w.start", "w.end").orderBy("start")
    return [((s - EPOCH).total_seconds(), (e - EPOCH).total_seconds()) for s, e in got.collect()]


def test_sliding_edges(spark):
    assert bounds(spark, RETAIL_WINDOWS, 12) == [(7, 17), (12, 22)]
    assert bounds(spark, RETAIL_WINDOWS, 11.999) == [(2, 12), (7, 17)]


def test_tumbling_edges(spark):
    assert bounds(spark, WORD_WINDOWS, 1) == [(-3, 2)]
    assert bounds(spark, WORD_WINDOWS, 2) == [(2, 7)]
    assert bounds(spark, WORD_WINDOWS, 7) == [(7, 12)]


def test_durations():
    assert micros("1 minute 30 seconds") == 90_000_000
    assert common_pane("10 seconds", "4 seconds") == "2000000 microseconds"
    with pytest.raises(ValueError):
        micros("10 months")
    with pytest.raises(ValueError):
        micros("soon")


@pytest.mark.parametrize(
    "windows",
    [
        Windows("10 days", "5 days", "2 days"),
        Windows("7 days", "3 days", "1 day"),
        Windows("30 days", "1 day"),
        Windows("6 days"),
    ],
)
def test_panes_equal_direct_aggregation(spark, small, windows):
    sales = spark.read.parquet(f"{small}/lineitem.parquet").selectExpr(
        "l_suppkey store_id", "cast(l_extendedprice as decimal(18,2)) price", "l_shipdate ts"
    )
    direct = windowed_aggregates(
        sales,
        windows,
        ["store_id"],
        [
            F.sum("price").cast("double").alias("sum_amount"),
            F.count("*").alias("tran_count"),
        ],
        "ts",
    )
    totals = amount_totals(sales, windows, "store_id", "price")
    order = ("window_start", "store_id")
    assert rows(totals, *order) == rows(direct, *order)


def test_sliding_keeps_every_row_in_each_of_its_windows(spark, small):
    sales = spark.read.parquet(f"{small}/lineitem.parquet")
    totals = amount_totals(
        sales, Windows("10 days", "5 days", "2 days"), "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    assert totals.agg(F.sum("tran_count")).first()[0] == 2 * sales.count()


def test_global_totals_without_key(spark):
    df = spark.createDataFrame([(at(1), 1.5), (at(4), 2.25), (at(5), 1.0)], "ts timestamp_ntz, price double")
    assert rows(amount_totals(df, Windows("5 seconds"), None, "price"), "window_start") == [
        (at(0), at(5), 3.75, 2),
        (at(5), at(10), 1.0, 1),
    ]


def test_counts_do_not_wrap(spark):
    big = 2**31 - 1
    df = spark.createDataFrame([("a", big, at(0)), ("a", big, at(1))], "name string, n int, ts timestamp_ntz")
    got = windowed_sums(df, Windows("3 seconds"), ["name"], "n", "ts", "n")
    assert rows(got) == [(at(0), at(3), "a", 2 * big)]


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, store_id int, price double")
    got = amount_totals(df, RETAIL_WINDOWS, "store_id", "price")
    assert got.collect() == []
    assert [f.dataType.simpleString() for f in got.schema] == [
        "timestamp_ntz", "timestamp_ntz", "int", "double", "bigint"
    ]


def test_hot_key_leaves_map_side_as_one_row_per_pane(spark):
    df = spark.range(100_000, numPartitions=4).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 5) ts",
        "if(id % 3 = 0, 1, id) store_id",
        "1.0D price",
    )
    plan = amount_totals(df, RETAIL_WINDOWS, "store_id", "price")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    hot = amount_totals(df, RETAIL_WINDOWS, "store_id", "price").where("store_id = 1")
    assert hot.agg(F.sum("tran_count")).first()[0] == 2 * 33_335


@pytest.mark.parametrize("column", ["l_extendedprice", "l_shipdate", "l_suppkey"])
def test_scan_reads_only_the_columns_it_needs(spark, small, column):
    import __spark_entry__ as entry

    plan = entry.queries()["q_store_sliding"](spark, small)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert column in schema and schema.count(":") == 3
