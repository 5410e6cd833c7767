import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from windrow.operators.publish import publish_records, round_robin
from windrow.schemas import BY_STORE, TRANSACTION
from windrow.sources import kafka
from windrow.sources.records import (
    decode,
    decode_by_product,
    decode_by_store,
    decode_or_quarantine,
    decode_transactions,
    encode_by_product,
    encode_by_store,
)

GOOD = {
    "transaction_id": 40001, "customer_id": 17, "store_id": 3, "price": 250, "product_id": 42,
    "date": "2024-01-01", "time": "00:00:00", "timestamp": 1704067200000,
}
MISSING = {k: v for k, v in GOOD.items() if k != "store_id"}
BAD = ["not json", "", json.dumps(MISSING), json.dumps({**GOOD, "price": None}), json.dumps({**GOOD, "store_id": "x"}),
       json.dumps({**GOOD, "price": "NaN"}), json.dumps({**GOOD, "price": float("inf")}), json.dumps({**GOOD, "date": 5}),
       json.dumps({**GOOD, "time": None}), json.dumps({**GOOD, "time": ["x"]}), json.dumps({**GOOD, "store_id": 2**31})]


def topic(spark, *values):
    data = [(v.encode() if isinstance(v, str) else json.dumps(v).encode(),) for v in values]
    return spark.createDataFrame(data, "value binary")


@pytest.mark.parametrize("price", [250, 250.5])
def test_decode(spark, price):
    got = decode_transactions(topic(spark, {**GOOD, "price": price, "extra": 1}))
    assert [f.dataType for f in got.schema] == [f.dataType for f in TRANSACTION]
    assert got.first().asDict() == {**GOOD, "price": price}


@pytest.mark.parametrize("bad", BAD)
def test_bad_record_fails_the_job(spark, bad):
    with pytest.raises(Exception):
        decode_transactions(topic(spark, GOOD, bad)).collect()


@pytest.mark.parametrize("bad", BAD)
def test_bad_record_fails_even_if_its_fields_are_not_used(spark, bad):
    with pytest.raises(Exception):
        decode(topic(spark, GOOD, bad), TRANSACTION).agg(F.max("product_id")).collect()
    with pytest.raises(Exception):
        decode(topic(spark, GOOD, bad), TRANSACTION).count()


def test_record_is_parsed_once(spark):
    for df in (decode_transactions(topic(spark, GOOD)), *decode_or_quarantine(topic(spark, GOOD), TRANSACTION)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_quarantine(spark):
    good, bad = decode_or_quarantine(topic(spark, GOOD, *BAD), TRANSACTION)
    assert [r.asDict() for r in good.collect()] == [GOOD]
    assert sorted(bytes(r.value).decode() for r in bad.collect()) == sorted(BAD)
    assert bad.columns == ["value"]


def test_totals_roundtrip(spark):
    at = datetime(2024, 1, 1, 0, 0, 2)
    totals = spark.createDataFrame(
        [(at, at.replace(second=12), 7, 10.25, 2**33), (at, at.replace(second=12), 8, 0.0, 1)],
        "window_start timestamp, window_end timestamp, store_id int, sum_amount double, tran_count bigint",
    )
    wire = encode_by_store(totals)
    assert [r.key for r in wire.orderBy("key").collect()] == ["7@1704067202000", "8@1704067202000"]
    assert set(json.loads(bytes(wire.first().value))) == set(BY_STORE.fieldNames())
    assert rows(decode_by_store(wire), "store_id") == rows(totals, "store_id")
    products = totals.withColumnRenamed("store_id", "product_id")
    assert rows(decode_by_product(encode_by_product(products)), "product_id") == rows(products, "product_id")


def test_publish_keys_and_partitions(spark):
    df = spark.range(1, 5).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(0,0,0,id) ts")
    got = publish_records(df, "id", {"id": "id"}).orderBy("key").collect()
    assert [(r.key, r.partition) for r in got] == [("1", 1), ("2", 2), ("3", 0), ("4", 1)]
    assert json.loads(bytes(got[0].value)) == {"id": 1}


def test_round_robin_within_a_task(spark):
    one = spark.range(7, numPartitions=1).select(round_robin(3).alias("p"))
    assert sorted(r["count"] for r in one.groupBy("p").count().collect()) == [2, 2, 3]
    many = spark.range(100, numPartitions=7).select(F.spark_partition_id().alias("t"), round_robin(3).alias("p"))
    for task in range(7):
        counts = [r["count"] for r in many.where(F.col("t") == task).groupBy("p").count().collect()]
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("tasks, each", [(200, 1), (7, 1000), (3, 2)])
def test_round_robin_over_all_tasks(spark, tasks, each):
    dealt = spark.range(tasks * each, numPartitions=tasks).groupBy(round_robin(3).alias("p")).count().collect()
    counts = {r.p: r["count"] for r in dealt}
    assert len(counts) == 3 and max(counts.values()) - min(counts.values()) <= max(2, tasks * each // 100)


def test_wide_ids(spark):
    at = datetime(2024, 1, 1)
    totals = spark.createDataFrame([(at, at, 2**40, 1.5, 1)], "window_start timestamp, window_end timestamp, store_id bigint, sum_amount double, tran_count bigint")
    assert decode_by_store(encode_by_store(totals)).first().store_id == 2**40


def test_decimal_sums_come_back_whole(spark):
    at = datetime(2024, 1, 1)
    totals = spark.createDataFrame([(at, at, 1, 1)], "window_start timestamp, window_end timestamp, store_id bigint, tran_count bigint")
    totals = totals.withColumn("sum_amount", F.lit("12345678901234567890.123456").cast("decimal(38,6)"))
    assert str(decode_by_store(encode_by_store(totals), "decimal(38,6)").first().sum_amount) == "12345678901234567890.123456"


def test_topic_options():
    assert kafka.reader_options("a:1,b:2", "sales", group="g", group_prefix="p") == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "sales", "startingOffsets": "earliest",
        "kafka.group.id": "g", "groupIdPrefix": "p",
    }
    assert "kafka.group.id" not in kafka.reader_options("a:1", "sales")
    assert kafka.reader_options("a:1", "sales", client_id="c")["kafka.client.id"] == "c"
    assert kafka.writer_options("a:1", "totals", client_id="c", **kafka.TOTALS_PRODUCER) == {
        "kafka.bootstrap.servers": "a:1", "topic": "totals", "kafka.batch.size": "100",
        "kafka.linger.ms": "1000", "kafka.retries": "3", "kafka.acks": "1", "kafka.client.id": "c",
    }
    assert kafka.writer_options("a:1", "t") == {"kafka.bootstrap.servers": "a:1", "topic": "t"}
