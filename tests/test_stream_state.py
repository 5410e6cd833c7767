"""Streams with state of their own: staggered windows, ordered reduces, pairs, fan-out, the two-phase sink."""

import random
import time
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from tests.compare import assert_same
from windrow.operators import ordered
from windrow.operators.halving import halving_reduce
from windrow.operators.lateness import flag_late_pairs
from windrow.operators.stagger import staggered
from windrow.operators.totals import pair_totals
from windrow.operators.windows import Windows, with_bounds
from windrow.session import date_in_order, remove_folder, stream_settings
from windrow.sources.replay import event_time, table_stream
from windrow.streaming import jobs, replayed, sinks
from windrow.streaming.late import open_totals, summed
from windrow.streaming.reduce import halved_stream
from windrow.streaming.runs import append_end_marker, drain
from windrow.streaming.stagger import staggered_totals, window_totals
from windrow.streaming.transactional import Folder, TransactionalFiles, TransactionalWriter, committed, sweep, to_transactions, transactional

START = datetime(2024, 1, 1)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture(autouse=True, scope="module")
def replays_removed(spark, shared):
    """The layout is tested on a run that never ends; other modules look for folders that are left."""
    yield
    remove_folder(spark, f"{shared}/replays")


def at(seconds):
    return START + timedelta(seconds=seconds)


def lay_out(spark, batches, schema, target):
    """One file a batch, oldest first."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(target)
        time.sleep(0.05)


def restarted(spark, stream_of, batches, schema, target, out, checkpoint, sink=sinks.files):
    """The first half of the batches, then the rest by a restarted query, then the end marker by another."""
    half = len(batches) // 2
    for part in (batches[:half], batches[half:], None):
        if part is None:
            append_end_marker(table_stream(spark, target, schema), target)
        else:
            lay_out(spark, part, schema, target)
        with stream_settings(spark):
            drain(sink(stream_of(), out, checkpoint))
    return out


SALES = "ts timestamp, store string, price decimal(18,2)"


def sales_batches():
    rng = random.Random(7)
    batches = []
    for b in range(4):
        rows = []
        for _ in range(60):
            t = at(b * 40 + rng.randrange(40_000_000) / 1e6)
            store = rng.choice(["a", "a", "a", "b", None])
            rows.append((t, store, rng.choice([1, -5, 99])))
        batches.append([(t, s, Decimal(p)) for t, s, p in rows])
    return batches


def test_staggered_totals_over_a_restart(spark, folder):
    batches = sales_batches()
    late = (at(3), "a", batches[0][0][2])  # its window is out by the third batch
    none = (None, "a", batches[0][0][2])
    fed = [batches[0], batches[1], [*batches[2], late, none], batches[3]]
    stream_of = lambda: staggered_totals(event_time(table_stream(spark, folder("in"), spark.createDataFrame([], SALES).schema), "ts", "0 seconds"), "10 seconds", "store", "price")
    out = restarted(spark, stream_of, fed, spark.createDataFrame([], SALES).schema, folder("in"), folder("out"), folder("ck"))
    whole = spark.createDataFrame([r for b in batches for r in b], SALES)
    want = pair_totals(staggered(whole, "10 seconds", "store"), "store", "price")
    assert_same(spark.read.parquet(out).toPandas(), want.toPandas())


def test_staggered_sums_are_exact_and_amounts_checked(spark):
    import numpy as np

    starts = np.array([5, 1, 5, 1, 5])
    amounts = np.array([9 * 10**17, -1, 9 * 10**17, 7, 9 * 10**17])
    assert window_totals(starts, amounts) == {1: (6, 2), 5: (27 * 10**17, 3)}
    stream = event_time(spark.readStream.format("rate").load().selectExpr("timestamp ts", "value", "'k' k"), "ts", "0 seconds")
    with pytest.raises(TypeError):
        staggered_totals(stream, "1 second", "k", F.col("value").cast("double"))


READINGS = "ts timestamp, sensor_id string, temperature double, reading_id bigint"


@pytest.mark.parametrize("delay, disorder", [("0 seconds", 0.0), ("5 seconds", 4.0)])
def test_ordered_runs_equal_the_batch_reduce(spark, folder, monkeypatch, delay, disorder):
    """A sensor with most rows, one without a name, missing values and rows out of order within the delay."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        sensor = "hot" if i % 3 else rng.choice(["s", None])
        value = None if i % 211 == 0 else rng.choice([rng.uniform(-50, 50), 1e308, float("inf")]) if i > 880 else rng.uniform(-50, 50)
        rows.append((at(i / 5), sensor, value, i))
    came = sorted(rows, key=lambda r: (r[0] - START).total_seconds() + rng.uniform(0, disorder))
    batches = [came[i : i + 150] for i in range(0, 900, 150)]
    windows = Windows("90 seconds")
    schema = spark.createDataFrame([], READINGS).schema
    stream_of = lambda: halved_stream(event_time(table_stream(spark, folder("in"), schema), "ts", delay), windows, run_rows=8)
    out = restarted(spark, stream_of, batches, schema, folder("in"), folder("out"), folder("ck"))
    monkeypatch.setattr(ordered, "RUN", 8)
    want = halving_reduce(spark.createDataFrame(rows, READINGS), windows)
    assert_same(spark.read.parquet(out).toPandas(), want.toPandas())


def test_no_entry_of_the_state_is_longer_than_a_run(spark, folder):
    schema = spark.createDataFrame([], READINGS).schema
    batches = [[(at(b * 100 + i / 20), "hot", float(i), b * 1000 + i) for i in range(1000)] for b in range(3)]
    stream_of = lambda: halved_stream(event_time(table_stream(spark, folder("in"), schema), "ts", "10 seconds"), Windows("1 hour"), run_rows=64)
    lay_out(spark, batches, schema, folder("in"))
    with stream_settings(spark):
        drain(sinks.files(stream_of(), folder("out"), folder("ck")))
        state = spark.read.format("statestore").option("stateVarName", "rows").load(folder("ck"))
        sizes = [r[0] for r in state.selectExpr("size(user_map_value.rows)").collect()]
    # rows that wait for the watermark, and less than two runs; the other 1 700 are one merged state
    assert max(sizes) <= 64 and 1000 <= sum(sizes) <= 1000 + 200 + 128


def test_rows_of_the_state_are_packed_and_rows_without_a_tiebreak_come_first(spark, folder):
    schema = spark.createDataFrame([], READINGS).schema
    batches = [[(at(b * 10), "hot", float(i), None if i == 7 else b * 100 + 2**60 + i) for i in range(20)] for b in range(2)]
    stream_of = lambda: halved_stream(event_time(table_stream(spark, folder("in"), schema), "ts", "1 second"), Windows("1 hour"), run_rows=4)
    lay_out(spark, batches, schema, folder("in"))
    with stream_settings(spark):
        drain(sinks.files(stream_of(), folder("out"), folder("ck")))
        state = spark.read.format("statestore").option("stateVarName", "rows").load(folder("ck"))
        assert state.selectExpr("user_map_value.rows").dtypes[0][1] == "array<binary>"
        append_end_marker(table_stream(spark, folder("in"), schema), folder("in"))
        drain(sinks.files(stream_of(), folder("out"), folder("ck")))
    (row,) = spark.read.parquet(folder("out")).collect()
    want = None
    for b in range(2):
        for x in [7.0, *(float(i) for i in range(20) if i != 7)]:
            want = x if want is None else (want + x) / 2
    assert row.n == 40 and row.temperature == pytest.approx(want, rel=1e-15)


ARRIVALS = "row_id bigint, ts timestamp, key string, price decimal(18,2), source_partition int, arrival bigint"
PAIRS = Windows("20 seconds", "10 seconds")


def arrival_rows():

    rng = random.Random(11)
    rows = []
    for i in range(400):
        t = at(i * 0.5 - (rng.uniform(0, 60) if i % 5 == 0 else 0))
        rows.append((i, t, rng.choice(["a", "a", None]), Decimal(rng.randrange(1000)), rng.choice([0, 0, 1]), i))
    return rows


def test_pairs_in_time_and_late_are_all_pairs(spark, folder):
    rows = arrival_rows()
    schema = spark.createDataFrame([], ARRIVALS).schema
    lay_out(spark, [rows[i : i + 100] for i in range(0, 400, 100)], schema, folder("in"))

    calls = Counter()

    def tried_twice(body):
        """Every batch comes again, as after a failure."""

        def write(batch, batch_id):
            body(batch, batch_id)
            calls[batch_id] += 1

        return write

    arrivals = table_stream(spark, folder("in"), schema)
    order = {"source": "source_partition", "arrival": "arrival", "tiebreak": "row_id"}
    from windrow.streaming.late import pair_split

    body = pair_split(folder("open"), tried_twice(sinks.batch_folder(folder("totals"))), sinks.batch_folder(folder("late")), "key", "price", PAIRS, "2 seconds", **order)
    twice = lambda batch, i: (body(batch, i), body(batch, i))
    drain(sinks.batches(arrivals, twice, folder("ck")))
    assert set(calls.values()) == {2} and len(calls) == 4

    whole = spark.createDataFrame(rows, ARRIVALS)
    flagged = flag_late_pairs(whole, PAIRS, "2 seconds", **order)
    late = with_bounds(flagged.where("late").select("window", "row_id"))
    assert 20 < late.count() < 200
    got_late = spark.read.parquet(folder("late")).select("window_start", "window_end", "row_id")
    assert Counter(map(tuple, got_late.collect())) == Counter(map(tuple, late.collect()))
    still_open = open_totals(spark, folder("open"))
    out = spark.read.parquet(folder("totals")).select(still_open.columns)
    assert out.count() and still_open.count()
    got = summed(out.unionByName(still_open), "key")
    want = pair_totals(flagged.where("not late"), "key", "price")
    assert_same(got.toPandas(), want.toPandas())
    assert got.agg(F.sum("tran_count")).first()[0] + late.count() == flagged.count() == 800


def test_one_query_feeds_both_branches(spark, folder, small):
    from windrow.operators.publish import publish_records, wire_fields
    from windrow.schemas import TOPIC_RECORD, TRANSACTION
    from windrow.sources import tables

    tx = tables.transactions(spark.read.parquet(f"{small}/events.parquet"))
    records = publish_records(tx, "transaction_id", wire_fields(TRANSACTION)).select(
        *[F.col(f.name).cast(f.dataType) for f in TOPIC_RECORD]
    )
    records.repartition(3).write.parquet(folder("in"))
    bodies = [sinks.batch_folder(folder(n)) for n in ("stores", "products")]
    windows = Windows("10 hours", "5 hours", "2 hours")
    job = jobs.fanned_job(table_stream(spark, folder("in"), TOPIC_RECORD, None), *bodies, windows, folder("cks"))
    query = drain(job)
    stores, products = (spark.read.parquet(folder(n)) for n in ("stores", "products"))
    assert stores.agg(F.sum("tran_count")).first() == products.agg(F.sum("tran_count")).first() != (None,)
    plan = query._jsq.explainInternal(False)
    assert plan.count("StateStoreSave") == 1 and plan.count("FileScan") + plan.count("Scan parquet") <= 2


class _Killed(TransactionalWriter):
    """Fails at its first end of a batch: before the commit, or right after it."""

    def __init__(self, path, when, flag):
        super().__init__(path)
        self.when, self.flag = when, flag

    def commit(self, messages, batchId):
        import os

        first = not os.path.exists(self.flag)
        open(self.flag, "w").close()
        if first and self.when == "before":
            raise RuntimeError("killed before the commit")
        super().commit(messages, batchId)
        if first and self.when == "after":
            raise RuntimeError("killed after the commit")

    def abort(self, messages, batchId):
        pass  # a killed query cleans nothing up


class _KilledFiles(DataSource):
    @classmethod
    def name(cls):
        return "killed-files"

    def streamWriter(self, schema, overwrite):
        return _Killed(self.options["path"], self.options["when"], self.options["flag"])


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_batch_is_there_once(spark, folder, when):
    schema = spark.createDataFrame([], "id bigint").schema
    lay_out(spark, [[(b * 10 + i,) for i in range(10)] for b in range(3)], schema, folder("in"))
    spark.dataSource.register(_KilledFiles)
    stream = table_stream(spark, folder("in"), schema)
    options = {"path": folder("out"), "when": when, "flag": folder("flag"), "checkpointLocation": folder("ck")}
    with pytest.raises(Exception, match="killed"):
        drain(stream.writeStream.format("killed-files").options(**options))
    seen = committed(spark, folder("out"), schema).count()
    assert seen == (0 if when == "before" else 10)
    drain(transactional(stream, folder("out"), folder("ck")))
    got = committed(spark, folder("out"), schema)
    assert sorted(r.id for r in got.collect()) == list(range(30))
    assert sweep(folder("out")) == (1 if when == "before" else 0)
    assert sorted(r.id for r in committed(spark, folder("out"), schema).collect()) == list(range(30))


def test_two_phases_of_the_sink(tmp_path):
    writer = TransactionalWriter(str(tmp_path))
    batch = pa.record_batch([pa.array([1, 2])], names=["id"])
    first, again, none = writer.write(iter([batch])), writer.write(iter([batch])), writer.write(iter([batch.slice(0, 0)]))
    at_folder = Folder(str(tmp_path))
    assert none.name is None and at_folder.committed() == [] and len(at_folder.staged()) == 2
    writer.commit([first, none, None], 0)
    writer.commit([again], 0)
    assert at_folder.committed() == at_folder.staged() == [first.name]
    third = writer.write(iter([batch]))
    writer.abort([third, None, none], 1)
    assert at_folder.staged() == [first.name]
    assert Folder(f"file://{tmp_path}").committed() == [first.name]


def test_jobs_take_the_sink_of_two_phases(spark, folder):
    schema = spark.createDataFrame([], "name string, n int").schema
    lay_out(spark, [[("a", 1)]], schema, folder("in"))
    writer = to_transactions(folder("out"))(table_stream(spark, folder("in"), schema), folder("ck"))
    drain(writer)
    assert [tuple(r) for r in committed(spark, folder("out"), schema).collect()] == [("a", 1)]


def test_the_layout_of_a_replay_keeps_null_orders_and_splits_instants(spark, shared, monkeypatch):
    monkeypatch.setattr(replayed, "FILE_ROWS", 1000)
    rows = spark.range(12_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 50 WHEN id % 100 = 1 THEN null ELSE id % 97 END AS at")
    run = replayed._Run(spark)
    stream = run.stream(rows, F.col("at"))
    laid = spark.read.parquet(run.input).select("id", "at", F.input_file_name().alias("file"), F.col("_metadata.file_modification_time").alias("dated"))
    assert laid.count() == laid.select("id").distinct().count() == 12_000
    per_file = laid.groupBy("file", "dated").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"), F.count_if(F.expr("at is null")).alias("none"), F.count_if(F.expr("at = 50")).alias("hot")).orderBy("dated").collect()
    assert len(per_file) == 12 == len({r.dated for r in per_file}) and max(r.n for r in per_file) < 2000
    assert [r.none > 0 for r in per_file] == [True] + [False] * 11
    ends = [(r.low, r.high) for r in per_file]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert sum(r.hot > 0 for r in per_file) >= 4
    batches = Counter()
    body = lambda df, i: batches.update({i: df.count()})
    drain(sinks.batches(stream, body, f"{run.folder}/ck"))
    assert len(batches) == 4 and sum(batches.values()) == 12_000
    date_in_order(spark, run.input)


def running(query, out, schema, want, spark):
    """Waits until a running query has written ``want`` rows."""
    import os

    got = []
    for _ in range(120):
        time.sleep(0.5)
        if os.path.isdir(out) and len(got := spark.read.schema(schema).parquet(out).collect()) >= want:
            break
    assert query.exception() is None
    return got


def test_timers_hand_out_windows_of_a_silent_input(spark, folder):
    units = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), ("b", None)], "name string, n int")
    units.coalesce(1).write.parquet(folder("in"))
    with stream_settings(spark):
        query = jobs.name_job(table_stream(spark, folder("in"), units.schema), Windows("1 second"), folder("ck"), sinks.to_files(folder("out")), timers=True).start()
    try:
        got = running(query, folder("out"), "window_start timestamp, window_end timestamp, name string, n bigint", 3, spark)
        assert Counter((r.name, r.n) for r in got) == Counter([("a", 2), ("b", 1), (None, 2)])
        assert all((r.window_end - r.window_start).total_seconds() == 1 for r in got)
        plan = query._jsq.explainInternal(True)
        assert "rate" not in plan.lower().split() and "RateStream" not in plan and "Union" not in plan
    finally:
        query.stop()


def test_timers_halve_readings_by_the_clock(spark, folder):
    rows = [(3, "s", 2.0), (1, "s", 8.0), (2, "s", 4.0)]
    spark.createDataFrame(rows, "timestamp long, sensorId string, temperature double").coalesce(1).write.parquet(folder("in"))
    stream = table_stream(spark, folder("in"), spark.read.parquet(folder("in")).schema)
    with stream_settings(spark):
        query = jobs.reading_job(stream, Windows("1 second"), True, folder("ck"), sinks.to_files(folder("out")), timers=True).start()
    try:
        (got,) = running(query, folder("out"), "sensorId string, first_ts bigint, temperature double, n bigint", 1, spark)
        assert tuple(got) == ("s", 1, 4.0, 3)
    finally:
        query.stop()


def test_a_slow_source_loses_nothing_and_a_silent_one_holds_nothing(spark, folder):
    """The slow source lags by 100 s but is heard in each batch; the silent one is heard in the first only."""
    from windrow.streaming.late import pair_split

    schema = spark.createDataFrame([], ARRIVALS).schema
    one = Decimal(1)
    batches, i = [], 0
    for b in range(6):
        rows = []
        for k in range(10):
            for source, lag in ((0, 0), (1, 100), *(((2, 0),) if b == 0 else ())):
                rows.append((i, at(1000 + b * 50 + 5 * k - lag), "k", one, source, i))
                i += 1
        batches.append(rows)
    lay_out(spark, batches, schema, folder("in"))
    order = {"source": "source_partition", "arrival": "arrival", "tiebreak": "row_id"}
    out = {}
    for name, idle in (("never", None), ("soon", "15 seconds")):
        now = iter(range(0, 10_000, 5))  # each look at the clock is 5 s later: two a batch
        body = pair_split(folder(f"open-{name}"), sinks.batch_folder(folder(f"totals-{name}")), sinks.batch_folder(folder(f"late-{name}")), "key", "price", PAIRS, "2 seconds", idle=idle, clock=lambda now=now: next(now), **order)
        drain(sinks.batches(table_stream(spark, folder("in"), schema), body, folder(f"ck-{name}")))
        still = open_totals(spark, folder(f"open-{name}"))
        totals = spark.read.parquet(folder(f"totals-{name}")).select(still.columns)
        assert spark.read.parquet(folder(f"late-{name}")).count() == 0
        whole = spark.createDataFrame([r for rows in batches for r in rows], ARRIVALS)
        want = pair_totals(whole.withColumn("window", PAIRS.of("ts")), "key", "price")
        assert_same(summed(totals.unionByName(still), "key").toPandas(), want.toPandas())
        out[name] = totals.agg(F.max("window_end")).first()[0]
    # without the idle rule the silent source, last seen at 1045 s, holds all later windows
    assert out["never"] <= at(1045)
    # with it the slow one does, which has come to 1195 s
    assert at(1150) <= out["soon"] <= at(1195)


def test_refused_records_are_kept_aside_and_counted(spark, folder):
    from windrow.operators.publish import publish_records, wire_fields
    from windrow.schemas import TOPIC_RECORD, TRANSACTION
    from windrow.sources import tables
    from windrow.streaming.counts import RecordCounts, decoded

    tx = tables.transactions(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    good = publish_records(tx, "transaction_id", wire_fields(TRANSACTION)).select(*[F.col(f.name).cast(f.dataType) for f in TOPIC_RECORD])
    bad = spark.createDataFrame([("x", "{}"), ("y", "no record"), ("z", None)], "key string, text string").select(
        "key", F.lit(0).alias("partition"), F.current_timestamp().alias("timestamp"), F.col("text").cast("binary").alias("value")
    ).select(*[F.col(f.name).cast(f.dataType) for f in TOPIC_RECORD])
    for i in range(3):
        good.where(F.col("partition") == i).unionByName(bad).coalesce(1).write.mode("append").parquet(folder("in"))
    counts = RecordCounts()
    spark.streams.addListener(counts)
    try:
        drain(decoded(table_stream(spark, folder("in"), TOPIC_RECORD), TRANSACTION, sinks.batch_folder(folder("good")), sinks.batch_folder(folder("bad")), folder("ck"), ("key",)))
        refused, rows = spark.read.parquet(folder("bad")), spark.read.parquet(folder("good"))
        for _ in range(40):  # the listener hears of a batch a little later
            if len(counts.by_batch) == 3:
                break
            time.sleep(0.25)
    finally:
        spark.streams.removeListener(counts)
    assert rows.count() == tx.count() and Counter(r.key for r in refused.collect()) == Counter({"x": 3, "y": 3, "z": 3})
    assert refused.drop("batch_id").columns == TOPIC_RECORD.fieldNames()
    assert counts.total == Counter({"n": tx.count() + 9, "refused": 9})


def test_offsets_start_restart_end_and_stop(spark, folder):
    from windrow.sources.offsets import RecordReader, record_stream

    def add(numbers, partition):
        spark.createDataFrame([(n, "x") for n in numbers], "n long, more string").coalesce(1).write.mode("append").parquet(f"{folder('in')}/partition={partition}")
        time.sleep(0.02)

    schema = spark.createDataFrame([], "n long").schema

    def read(checkpoint, **offsets):
        drain(sinks.files(record_stream(spark, folder("in"), schema, **offsets), folder(checkpoint) + "-out", folder(checkpoint)))
        return sorted(r.n for r in spark.read.schema(schema).parquet(folder(checkpoint) + "-out").collect())

    add(range(5), 0)
    add(range(100, 103), 1)
    assert read("all") == [*range(5), 100, 101, 102]
    assert read("all") == [*range(5), 100, 101, 102]  # nothing new
    add(range(200, 202), 2)  # a new partition
    assert read("all") == [*range(5), 100, 101, 102, 200, 201]
    for n in range(300, 306):  # names of later files come before and after those of earlier ones
        add([n], 3)
        assert read("all")[10:] == list(range(300, n + 1))
    assert read("from", start={"0": 3, "1": 3, "3": 5}) == [3, 4, 200, 201, 305]
    assert read("upto", end={"0": 2, "1": 1}) == [0, 1, 100]
    assert read("upto", end={"0": 4, "1": 1}) == [0, 1, 2, 3, 100]
    reader = RecordReader(folder("in"), ["n"], {}, None)
    assert reader.initialOffset() == {} and reader.latestOffset() == {"0": 5, "1": 3, "2": 2, "3": 6}
    parts = reader.partitions({"0": 1, "1": 3}, {"0": 4, "1": 3, "2": 2})
    assert [(p.first, p.past) for p in parts] == [(1, 4), (0, 2)]
    assert [b.column(0).to_pylist() for p in parts for b in reader.read(p)] == [[1, 2, 3], [200, 201]]
    reader.commit({"0": 4})
    assert reader.done == {"0": 4}
    reader.stop()
    assert RecordReader(folder("nothing"), ["n"], {}, None).latestOffset() == {}
