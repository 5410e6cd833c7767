"""Streams over replayed files give what the batch form gives."""

import json
import os
import subprocess
import sys
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from windrow.functions.text import explode_words
from windrow.operators.halving import halving_reduce, halving_reduce_stream
from windrow.operators.lateness import closed_windows, split_late
from windrow.operators.publish import publish_records, wire_fields
from windrow.operators.rollup import global_rollup, window_time
from windrow.operators.windows import NO_DELAY, Windows
from windrow.plans import names, retail, words
from windrow.schemas import BY_STORE, READING, TOPIC_RECORD, TRANSACTION
from windrow.session import STREAM_SETTINGS, shared_dir, tolerate_idle_sources
from windrow.sources import tables
from windrow.sources.replay import event_time, line_stream, table_stream
from windrow.sources.records import decode_by_store
from windrow.streaming import jobs, sinks
from windrow.streaming.late import late_split
from windrow.streaming.runs import append_end_marker, append_end_record, drain

HOURS = Windows("10 hours", "5 hours", "2 hours")
DAY = Windows("1 day")


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def write_files(df, target, order, pieces=4):
    """The rows as parquet files, oldest rows in the oldest file."""
    edges = df.approxQuantile(order, [i / pieces for i in range(1, pieces)], 0.0)
    lows, highs = [None, *edges], [*edges, None]
    for low, high in zip(lows, highs):
        part = df
        part = part if low is None else part.where(F.col(order) > low)
        part = part if high is None else part.where(F.col(order) <= high)
        part.coalesce(1).write.mode("append").parquet(target)
        time.sleep(0.05)
    return target


def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


def instants(df):
    """Times as TIMESTAMP, as streams have them."""
    return df.select(
        *[F.col(f.name).cast("timestamp" if "timestamp" in f.dataType.simpleString() else f.dataType).alias(f.name) for f in df.schema]
    )


def transactions(spark, small):
    return instants(tables.transactions(events(spark, small)))


def replay(spark, df, target, order, ts, delay):
    stream = table_stream(spark, write_files(df, target, order), df.schema)
    return event_time(stream, ts, delay, ts)


def finish(spark, writer, rows_df, source, out, ts="ts"):
    """Run to the end, add the end marker, run on; returns (before, after)."""
    drain(writer())
    before = spark.read.parquet(out)
    before = spark.createDataFrame(before.collect(), before.schema)
    append_end_marker(rows_df, source, ts)
    drain(writer())
    return before, spark.read.parquet(out)


def test_store_totals_stream_equals_batch(spark, small, folder):
    tx = transactions(spark, small).select("transaction_id", "ts", "store_id", "price")
    stream = replay(spark, tx, folder("in"), "transaction_id", "ts", "2 seconds")
    totals = retail.store_totals(stream, HOURS)
    batch = retail.store_totals(tx, HOURS)
    before, after = finish(
        spark, lambda: sinks.files(totals, folder("out"), folder("ck")), tx, folder("in"), folder("out")
    )
    order = ("window_start", "store_id")
    assert rows(before, *order) == rows(closed_windows(batch, tx), *order)
    assert before.count() < batch.count()
    assert rows(after, *order) == rows(batch, *order)


def test_restart_repeats_nothing(spark, small, folder):
    tx = transactions(spark, small).select("transaction_id", "ts", "store_id", "price")
    stream = replay(spark, tx, folder("in"), "transaction_id", "ts", "2 seconds")
    totals = retail.store_totals(stream, HOURS)
    for _ in range(3):
        drain(sinks.files(totals, folder("out"), folder("ck")))
    out = spark.read.parquet(folder("out"))
    assert rows(out, "window_start", "store_id") == rows(
        closed_windows(retail.store_totals(tx, HOURS), tx), "window_start", "store_id"
    )


def test_fan_out_branches_account_for_the_same_rows(spark, small, folder):
    tx = transactions(spark, small).select("transaction_id", "ts", "store_id", "product_id", "price")
    stream = replay(spark, tx, folder("in"), "transaction_id", "ts", "2 seconds")
    append_end_marker(tx, folder("in"))
    sums = []
    for name, branch in zip(("store", "product"), retail.fan_out(stream, HOURS)):
        drain(sinks.files(branch, folder(name), folder(f"ck-{name}")))
        sums.append(spark.read.parquet(folder(name)).agg(F.sum("tran_count"), F.round(F.sum("sum_amount"), 2)).first())
    assert sums[0] == sums[1]
    assert sums[0][0] == 2 * tx.count()


def test_two_stages_through_a_topic_table(spark, small, folder):
    """Published JSON -> per-store totals -> published JSON -> global roll-up, each a stream."""
    tx = transactions(spark, small)
    topic = publish_records(tx, "transaction_id", wire_fields(TRANSACTION)).withColumn("n", F.col("key").cast("long"))
    write_files(topic, folder("topic"), "n")
    stream = table_stream(spark, folder("topic"), TOPIC_RECORD)
    first = retail.store_records(retail.transactions_of(stream), HOURS)
    drain(sinks.batches(first, sinks.batch_folder(folder("totals")), folder("ck1")))
    published = spark.read.parquet(folder("totals")).schema
    second = retail.rollup_of_records(
        table_stream(spark, folder("totals") + "/*", published), Windows("5 hours"), delay="10 days"
    )
    drain(sinks.files(second, folder("out"), folder("ck2")))
    got = rows(spark.read.parquet(folder("out")), "window_start")

    millis = tx.withColumn("ts", F.timestamp_millis("timestamp"))
    closed = closed_windows(retail.store_totals(millis, HOURS), millis)
    want = rows(global_rollup(window_time(closed), Windows("5 hours")), "window_start")
    # The newest windows are still open when the second stream has read all its input.
    assert 80 < len(got) < len(want) and got == want[: len(got)]


def test_chained_rollup_in_one_stream(spark, small, folder):
    tx = transactions(spark, small).select("transaction_id", "ts", "store_id", "price")
    stream = replay(spark, tx, folder("in"), "transaction_id", "ts", "2 seconds")
    append_end_marker(tx, folder("in"))
    rolled = retail.rollup_in_one(stream, HOURS, Windows("5 hours"))
    drain(sinks.files(rolled, folder("out"), folder("ck")))
    want = retail.rollup_in_one(tx, HOURS, Windows("5 hours"))
    assert rows(spark.read.parquet(folder("out")), "window_start") == rows(want, "window_start")


def test_name_sums_stream(spark, small, folder):
    units = instants(tables.named_units(events(spark, small)))
    write_files(units.withColumn("o", F.unix_micros("arrival_ts")), folder("in"), "o")
    append_end_marker(units, folder("in"), "arrival_ts")
    stream = event_time(table_stream(spark, folder("in"), units.schema), "arrival_ts", NO_DELAY, "arrival_ts")
    drain(sinks.files(names.name_sums(stream, Windows("3 hours")), folder("out"), folder("ck")))
    want = names.name_sums(units, Windows("3 hours"))
    assert rows(spark.read.parquet(folder("out")), "window_start", "name") == rows(want, "window_start", "name")


def test_halving_stream_equals_batch(spark, small, folder):
    readings = instants(tables.readings(events(spark, small)))
    stream = replay(spark, readings, folder("in"), "reading_id", "ts", NO_DELAY)
    append_end_marker(readings, folder("in"))
    out = halving_reduce_stream(stream, DAY, pane="3 hours")
    drain(sinks.files(out, folder("out"), folder("ck")))
    got = rows(spark.read.parquet(folder("out")), "window_start", "sensor_id")
    want = rows(halving_reduce(readings, DAY), "window_start", "sensor_id")
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[5] == w[5]
        assert g[4] == pytest.approx(w[4], rel=1e-13)


def test_line_stream_words(spark, folder):
    os.makedirs(folder("in"))
    with open(folder("in") + "/a.txt", "w", newline="") as f:
        f.write("b a\r\na\n\nlast line")
    lines = line_stream(spark, folder("in"))
    drain(sinks.batches(lines, sinks.batch_folder(folder("lines")), folder("ck1")))
    assert sorted(r.value for r in spark.read.parquet(folder("lines")).collect()) == ["", "a", "b a", "last line"]
    drain(
        sinks.batches(
            explode_words(lines, "value").groupBy("word").count(),
            sinks.batch_folder(folder("out")),
            folder("ck2"),
            "complete",
        )
    )
    got = {r.word: r["count"] for r in spark.read.parquet(folder("out")).collect()}
    assert got == {"": 1, "a": 2, "b": 1, "last": 1, "line": 1}


def test_word_totals_stream(spark, small, folder):
    texts = instants(tables.texts(spark.read.parquet(f"{small}/documents.parquet")))
    lines = texts.select("doc_id", "ts", F.explode(F.split("text", "\n")).alias("line"))
    write_files(lines, folder("in"), "doc_id")
    append_end_marker(lines, folder("in"))
    stream = event_time(table_stream(spark, folder("in"), lines.schema), "ts", NO_DELAY)
    drain(sinks.files(words.word_totals(stream), folder("out"), folder("ck")))
    want = words.word_totals(lines)
    got = spark.read.parquet(folder("out"))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_watermark_drops_late_rows(spark, folder):
    layout = "ts timestamp, name string, n int"

    def put(second, n):
        ts = datetime(2024, 1, 1, 0, second // 60, second % 60)
        spark.createDataFrame([(ts, "a", n)], layout).coalesce(1).write.mode("append").parquet(folder("in"))
        time.sleep(0.05)

    for second, n in ((1, 1), (100, 1), (101, 1), (102, 1), (2, 50), (200, 1)):
        put(second, n)
    stream = event_time(table_stream(spark, folder("in"), spark.read.parquet(folder("in")).schema), "ts", "2 seconds")
    out = names.name_sums(stream, Windows("10 seconds"), "ts")
    query = drain(sinks.files(out, folder("out"), folder("ck")))
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 1
    assert [(r.window_start.second, r.n) for r in spark.read.parquet(folder("out")).orderBy("window_start").collect()] == [
        (0, 1), (40, 3)
    ]


def test_late_rows_of_a_stream_go_to_the_side(spark, small, folder):
    windows = Windows("2 hours", "1 hour")
    arrivals = instants(tables.shuffled_arrivals(events(spark, small)))
    write_files(arrivals, folder("in"), "arrival", pieces=3)
    body = late_split(
        folder("seen"), sinks.batch_folder(folder("main")), sinks.batch_folder(folder("side")), windows, "2 seconds"
    )
    drain(sinks.batches(table_stream(spark, folder("in"), arrivals.schema), body, folder("ck")))
    on_time, late = split_late(arrivals, windows, "2 seconds")
    columns = arrivals.columns
    for name, want in (("main", on_time), ("side", late)):
        got = spark.read.parquet(folder(name)).select(columns)
        assert rows(got, "row_id") == rows(want.select(columns), "row_id")
    assert late.count() > 0


def test_retried_batch_replaces_itself(spark, folder):
    write = sinks.batch_folder(folder("out"))
    write(spark.range(3).toDF("x"), 0)
    write(spark.range(5).toDF("x"), 1)
    write(spark.range(4).toDF("x"), 1)
    assert spark.read.parquet(folder("out")).count() == 7


def test_twin_outputs(spark, folder):
    spark.range(10).coalesce(1).write.parquet(folder("in"))
    body = sinks.twin(
        lambda b: (b.where("id < 7"), b.where("id >= 7")),
        sinks.batch_folder(folder("main")),
        sinks.batch_folder(folder("side")),
    )
    drain(sinks.batches(table_stream(spark, folder("in"), spark.range(1).schema), body, folder("ck")))
    assert spark.read.parquet(folder("main")).count() == 7
    assert spark.read.parquet(folder("side")).count() == 3


class Recorder(sinks.LifecycleWriter):
    def __init__(self, folder):
        self.folder = folder

    def _note(self, text):
        with open(f"{self.folder}/{os.getpid()}-{time.time_ns()}", "w") as f:
            f.write(text)

    def open(self, partition_id, epoch_id):
        self._note("open")
        return super().open(partition_id, epoch_id)

    def process(self, row):
        self._note(f"row {row.id}")

    def close(self, error):
        self._note("close")


def test_lifecycle_sink(spark, folder):
    os.makedirs(folder("notes"))
    for i in range(3):
        spark.range(i * 2, i * 2 + 2).coalesce(1).write.mode("append").parquet(folder("in"))
    stream = table_stream(spark, folder("in"), spark.range(1).schema)
    drain(sinks.rows_to(stream, Recorder(folder("notes")), folder("ck")))
    notes = [open(f"{folder('notes')}/{n}").read() for n in os.listdir(folder("notes"))]
    assert notes.count("open") == notes.count("close") == 3
    assert sorted(n for n in notes if n.startswith("row")) == [f"row {i}" for i in range(6)]


PRINTING = """
import sys
from windrow.session import local_session
from windrow.sources.replay import table_stream
from windrow.streaming import sinks
spark = local_session(2, "printing")
rows = spark.sql("SELECT id, IF(id = 2, NULL, concat('näme ', id)) AS name, CAST(id AS DECIMAL(5,2)) AS amount FROM range(3)")
rows.repartition(3).write.parquet(sys.argv[1] + "/in")
query = sinks.printed(table_stream(spark, sys.argv[1] + "/in", rows.schema), sys.argv[1] + "/ck").trigger(availableNow=True).start()
query.awaitTermination()
"""


def test_printed_rows(folder):
    done = subprocess.run([sys.executable, "-c", PRINTING, folder("")], capture_output=True, text=True, timeout=120, check=True, cwd=os.path.dirname(os.path.dirname(__file__)))
    lines = [json.loads(line) for line in (done.stdout + done.stderr).splitlines() if line.startswith('{"id"')]
    assert sorted(lines, key=lambda r: r["id"]) == [
        {"id": 0, "name": "näme 0", "amount": 0.0}, {"id": 1, "name": "näme 1", "amount": 1.0}, {"id": 2, "name": None, "amount": 2.0}
    ]


def test_retail_job_over_a_topic_table(spark, small, folder):
    tx = transactions(spark, small)
    for low in range(0, 1000, 250):
        jobs.publish(tx.where(f"transaction_id between {low} and {low + 249}"), folder("topic"))
    assert spark.read.parquet(folder("topic")).select(TOPIC_RECORD.fieldNames()).count() == 1000
    stream = table_stream(spark, folder("topic"), TOPIC_RECORD)
    for writer in jobs.retail_job(stream, folder("out"), HOURS, 3, folder("ck")):
        assert drain(writer).exception() is None
    out = spark.read.parquet(folder("out"))
    millis = tx.withColumn("ts", F.timestamp_millis("timestamp"))
    want = closed_windows(retail.store_totals(millis, HOURS), millis)
    assert rows(decode_by_store(out), "window_start", "store_id") == rows(want, "window_start", "store_id")
    assert {r.partition for r in out.select("partition").distinct().collect()} == {0, 1, 2}


def test_clock_jobs_start_and_keep_open_windows(spark, small, folder):
    """By the clock nothing closes before the input ends; the jobs must run and keep their state."""
    units = tables.named_units(events(spark, small)).select("name", "n")
    units.write.parquet(folder("units"))
    readings = events(spark, small).select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lit("s").alias("sensorId"),
        F.col("value").alias("temperature"),
    )
    readings.write.parquet(folder("readings"))
    os.makedirs(folder("text"))
    with open(folder("text") + "/a.txt", "w") as f:
        f.write("a b\n")
    day = Windows("1 day")
    queries = [
        drain(jobs.name_job(table_stream(spark, folder("units"), units.schema), day, folder("ck"))),
        drain(jobs.reading_job(table_stream(spark, folder("readings"), READING), day, True, folder("ck"))),
        drain(jobs.word_job(line_stream(spark, folder("text")), day, folder("ck"))),
    ]
    for query in queries:
        assert query.exception() is None
        operators = [o for p in query.recentProgress for o in p["stateOperators"]]
        assert sum(o["numRowsUpdated"] for o in operators) > 0


def test_rollup_job_hands_rows_to_the_writer(spark, small, folder):
    tx = transactions(spark, small)
    records = retail.store_records(tx, HOURS)
    records.coalesce(1).write.parquet(folder("in"))
    records.limit(0).coalesce(1).write.mode("append").parquet(folder("in"))
    os.makedirs(folder("notes"))
    stream = table_stream(spark, folder("in"), records.schema)

    class Rollups(Recorder):
        def process(self, row):
            self._note(f"row {row.window_start} {row.tran_count}")

    writer = jobs.rollup_job(
        stream, Rollups(folder("notes")), Windows("5 hours"), by_clock=False, checkpoints=folder("ck")
    )
    drain(writer)
    notes = [open(f"{folder('notes')}/{n}").read() for n in os.listdir(folder("notes"))]
    want = retail.rollup_in_one(tx, HOURS, Windows("5 hours"))
    newest = want.agg(F.max("window_start")).first()[0]
    assert sorted(n for n in notes if n.startswith("row")) == sorted(
        f"row {r.window_start} {r.tran_count}" for r in want.where(F.col("window_start") < newest).collect()
    )


def test_checkpoints_default_to_the_shared_folder(spark, shared):
    assert jobs.checkpoint_of(spark.range(1), "x") == shared + "/checkpoints/x"
    assert jobs.checkpoint_of(spark.range(1), "x", "/own") == "/own/x"


def test_shared_folder_where_none_is_set():
    class Conf:
        get = staticmethod(lambda key, default: {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(key, default))

    class Session:
        conf = Conf

        class sparkContext:
            master = "local[8]"

    assert shared_dir(Session) == "hdfs://store/warehouse"
    Session.sparkContext.master = "yarn"  # a cluster's warehouse may be a folder of one machine
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)


@pytest.mark.parametrize("policy, closed", [("min", 0), ("max", 2)])
def test_idle_source_of_a_union(spark, folder, policy, closed):
    layout = "arrival_ts timestamp, name string, n int"
    busy = [(datetime(2024, 1, 1, 0, 0, s), "a", 1) for s in (1, 5, 9)]
    spark.createDataFrame(busy, layout).coalesce(1).write.parquet(folder("busy"))
    spark.createDataFrame([], layout).coalesce(1).write.parquet(folder("idle"))
    schema = spark.read.parquet(folder("busy")).schema
    one, other = (
        event_time(table_stream(spark, folder(f), schema), "arrival_ts", NO_DELAY, "arrival_ts")
        for f in ("busy", "idle")
    )
    before = spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy")
    try:
        if policy == "max":
            tolerate_idle_sources(spark)
        drain(sinks.files(names.name_sums(one.union(other)), folder("out"), folder("ck")))
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", before)
    got = spark.read.schema("n bigint").parquet(folder("out"))
    assert got.count() == closed


@pytest.mark.parametrize("stream", [False, True])
def test_repeated_totals_count_once(spark, small, folder, stream):
    tx = transactions(spark, small)
    records = retail.store_records(tx, HOURS)
    records.coalesce(1).write.parquet(folder("in"))
    records.sample(0.3, seed=1).coalesce(1).write.mode("append").parquet(folder("in"))
    want = rows(retail.rollup_in_one(tx, HOURS, Windows("5 hours")), "window_start")
    if not stream:
        got = retail.rollup_of_records(spark.read.parquet(folder("in")), Windows("5 hours"), repeats=True)
        assert rows(got, "window_start") == want
        return
    source = table_stream(spark, folder("in"), records.schema)
    got = retail.rollup_of_records(source, Windows("5 hours"), delay="3 days", repeats=True)
    drain(sinks.files(got, folder("out"), folder("ck")))
    out = rows(spark.read.parquet(folder("out")), "window_start")
    assert 80 < len(out) < len(want) and out == want[: len(out)]


def test_cluster_stream_settings(spark, small, folder):
    """The state store meant for clusters gives the same result."""
    tx = transactions(spark, small).select("transaction_id", "ts", "store_id", "price")
    stream = replay(spark, tx, folder("in"), "transaction_id", "ts", "2 seconds")
    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    try:
        for key, value in STREAM_SETTINGS.items():
            spark.conf.set(key, value)
        drain(sinks.files(retail.store_totals(stream, HOURS), folder("out"), folder("ck")))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    want = closed_windows(retail.store_totals(tx, HOURS), tx)
    order = ("window_start", "store_id")
    assert rows(spark.read.parquet(folder("out")), *order) == rows(want, *order)


def published(spark, small, folder, pieces=4):
    """Transactions as topic records in several files, and the transactions as they come back."""
    tx = transactions(spark, small)
    for low in range(0, 1000, 1000 // pieces):
        jobs.publish(tx.where(f"transaction_id between {low} and {low + 1000 // pieces - 1}"), folder)
        time.sleep(0.02)
    return tx.withColumn("ts", F.timestamp_millis("timestamp"))


def test_end_record_flushes_the_retail_job(spark, small, folder):
    tx = published(spark, small, folder("topic"))
    stream = table_stream(spark, folder("topic"), TOPIC_RECORD)
    for turn in range(2):
        for writer in jobs.retail_job(stream, folder("out"), HOURS, None, folder("ck"), sinks.to_files(folder("products"))):
            drain(writer)
        if not turn:
            append_end_record(spark, folder("topic"), TRANSACTION, ["timestamp"])
    assert rows(decode_by_store(spark.read.parquet(folder("out"))), "window_start", "store_id") == rows(
        retail.store_totals(tx, HOURS), "window_start", "store_id"
    )
    assert rows(spark.read.parquet(folder("products")), "window_start", "product_id") == rows(
        retail.product_totals(tx, HOURS), "window_start", "product_id"
    )


def test_end_marker_of_times_in_milliseconds(spark, folder):
    data = [(1_700_000_000_000 + 1000 * i, "s", float(i)) for i in range(5)]
    spark.createDataFrame(data, READING).coalesce(1).write.parquet(folder("in"))
    append_end_marker(spark.createDataFrame([], READING), folder("in"), "timestamp")
    stream = table_stream(spark, folder("in"), READING)
    drain(jobs.reading_job(stream, Windows("1 minute"), clock=False, checkpoints=folder("ck"), sink=sinks.to_files(folder("out"))))
    assert spark.read.parquet(folder("out")).agg(F.sum("n")).first()[0] == 5


def test_rollup_job_counts_a_repeated_total_once(spark, small, folder):
    tx = transactions(spark, small)
    records = retail.store_records(tx, HOURS)
    records = records.select("key", F.lit(0).alias("partition"), F.lit(None).cast("timestamp").alias("timestamp"), "value")
    for _ in range(2):
        records.coalesce(1).write.mode("append").parquet(folder("in"))
    os.makedirs(folder("notes"))

    class Counts(Recorder):
        def process(self, row):
            self._note(f"row {row.window_start} {row.tran_count}")

    stream = table_stream(spark, folder("in"), TOPIC_RECORD, None)
    writer = jobs.rollup_job(stream, Counts(folder("notes")), Windows("5 hours"), False, checkpoints=folder("ck"))
    drain(writer)
    append_end_record(spark, folder("in"), BY_STORE, ["windowStart", "windowEnd"])
    drain(writer)
    notes = [open(f"{folder('notes')}/{n}").read() for n in os.listdir(folder("notes"))]
    want = retail.rollup_in_one(tx, HOURS, Windows("5 hours")).collect()
    assert sorted(n for n in notes if n.startswith("row")) == sorted(f"row {r.window_start} {r.tran_count}" for r in want)


def test_job_with_main_and_side_output(spark, small, folder):
    windows = Windows("2 hours", "1 hour")
    arrivals = instants(tables.shuffled_arrivals(events(spark, small)))
    write_files(arrivals, folder("in"), "arrival", pieces=4)
    stream = table_stream(spark, folder("in"), arrivals.schema)
    job = jobs.split_job(stream, sinks.batch_folder(folder("main")), sinks.batch_folder(folder("side")), windows, "2 seconds", folder("ck"))
    drain(job)
    on_time, late = split_late(arrivals, windows, "2 seconds")
    for name, want in (("main", on_time), ("side", late)):
        assert rows(spark.read.parquet(folder(name)).select("row_id"), "row_id") == rows(want.select("row_id"), "row_id")


def test_clock_windows_fire_while_the_input_is_silent(spark, folder):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "name string, n int").coalesce(1).write.parquet(folder("in"))
    stream = table_stream(spark, folder("in"), spark.read.parquet(folder("in")).schema)
    query = jobs.name_job(stream, Windows("1 second"), folder("ck"), sinks.to_files(folder("out"))).start()
    try:
        for _ in range(120):
            time.sleep(0.5)
            if os.path.isdir(folder("out")) and (got := spark.read.schema("name string, n bigint").parquet(folder("out")).collect()):
                break
        assert query.exception() is None and sorted((r.name, r.n) for r in got) == [("a", 2), ("b", 1)]
    finally:
        query.stop()


def test_targets_of_many_small_batches(spark, folder):
    totals = [0, 0, 0]

    def count(batch, batch_id):
        for r in batch.groupBy("partition").count().collect():
            totals[r.partition] += r["count"]

    for i in range(40):
        sinks.dealt(count, 3)(spark.range(25, numPartitions=1 + i % 7), i)
    assert sum(totals) == 1000 and max(totals) - min(totals) <= 10


def test_replays_take_several_batches_and_leave_no_folder(spark, small, shared, monkeypatch):
    from windrow.streaming import replayed, runs

    seen = []
    monkeypatch.setattr(replayed, "drain", lambda writer: seen.append(runs.drain(writer)))
    for replay_query in replayed.REPLAYS.values():
        seen.clear()
        replay_query(spark, small)
        assert len({p["batchId"] for query in seen for p in query.recentProgress if p["numInputRows"]}) >= 3
    assert not os.path.isdir(f"{shared}/replays") or not os.listdir(f"{shared}/replays")
