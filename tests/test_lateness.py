from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from windrow.operators.chunks import with_chunks
from windrow.operators.lateness import closed_windows, on_time_pairs, split_late, with_seen
from windrow.operators.totals import amount_totals
from windrow.operators.windows import RETAIL_WINDOWS, Windows

EPOCH = datetime(1970, 1, 1)
LAYOUT = "row_id bigint, source_partition bigint, arrival bigint, ts timestamp_ntz"


def at(seconds):
    return EPOCH + timedelta(seconds=seconds)


def arrivals(spark, data):
    return spark.createDataFrame([(i, p, a, at(s)) for i, (p, a, s) in enumerate(data)], LAYOUT)


def running_max(data):
    best, out = {}, {}
    for i, (p, a, s) in sorted(enumerate(data), key=lambda e: (e[1][1], e[0])):
        out[i] = best.get(p)
        best[p] = max(s, best.get(p, s))
    return out


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.sampled_from([0, 0, 0, 1, 2, 7, 10**17]), st.integers(0, 60)),
        max_size=40,
    )
)
def test_seen_equals_a_plain_scan(spark, data):
    got = {r.row_id: r.seen for r in with_seen(arrivals(spark, data), chunks=5).collect()}
    assert got == {i: None if s is None else at(s) for i, s in running_max(data).items()}


def test_one_source_and_one_instant_are_spread(spark):
    df = spark.range(10_000).selectExpr(
        "id row_id", "0L source_partition", "if(id % 3 = 0, 5L, id) arrival",
        "timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, pmod(hash(id), 1000)) ts",
    )
    sizes = with_chunks(df, F.col("arrival"), F.col("row_id"), 20).groupBy("chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1100
    assert sizes.agg(F.sum("count")).first()[0] == 10_000
    seconds = [(r.source_partition, r.arrival, (r.ts - EPOCH).total_seconds()) for r in df.orderBy("row_id").collect()]
    want = running_max(seconds)
    got = {r.row_id: r.seen for r in with_seen(df, chunks=20).collect()}
    assert got == {i: None if s is None else at(s) for i, s in want.items()}


def test_chunks_follow_the_order(spark):
    df = spark.range(5_000).selectExpr("if(id % 4 = 0, 7L, pmod(xxhash64(id), 50)) a", "xxhash64(id, 1) b")
    cut = with_chunks(df, F.col("a"), F.col("b"), 32).orderBy("a", "b").select("chunk").collect()
    chunks = [r.chunk for r in cut]
    assert chunks == sorted(chunks) and len(set(chunks)) > 16


def test_late_for_the_older_window_only(spark):
    # The third row is late for [2, 12) and on time for [7, 17).
    df = arrivals(spark, [(0, 0, 8), (0, 1, 14), (0, 2, 9)])
    on_time, late = split_late(df, RETAIL_WINDOWS)
    assert on_time.count() == 3 and late.count() == 0
    pairs = on_time_pairs(df, RETAIL_WINDOWS).where("row_id = 2").select("window.start").collect()
    assert [r.start for r in pairs] == [at(7)]


def test_fully_late_row_goes_to_the_side(spark):
    df = arrivals(spark, [(0, 0, 8), (0, 1, 19), (0, 2, 9), (1, 3, 9)])
    on_time, late = split_late(df, RETAIL_WINDOWS)
    assert [r.row_id for r in late.collect()] == [2]
    assert sorted(r.row_id for r in on_time.collect()) == [0, 1, 3]


@pytest.mark.parametrize("newest, closes", [(13.999, False), (14.0, True)])
def test_close_rule(spark, newest, closes):
    df = arrivals(spark, [(0, 0, 3), (0, 1, newest)]).withColumn("price", F.lit(1.0))
    windows = Windows("10 seconds", None, "2 seconds")
    totals = amount_totals(df, windows, "source_partition", "price")
    ends = [r.window_end for r in closed_windows(totals, df).collect()]
    assert ends == ([at(12)] if closes else [])


def test_on_time_and_late_are_everything(spark, small):
    from windrow.sources.tables import shuffled_arrivals

    df = shuffled_arrivals(spark.read.parquet(f"{small}/events.parquet"))
    on_time, late = split_late(df, Windows("2 hours", "1 hour"))
    assert late.count() > 0
    assert rows(on_time.unionByName(late), "row_id") == rows(df.select(on_time.columns), "row_id")


def test_closed_cut_is_applied_before_the_shuffle(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet").selectExpr("ts", "user_id store_id", "value price")
    cut = closed_windows(amount_totals(df, Windows("1 day"), "store_id", "price"), df)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert plan.index("Aggregate") < plan.index("scalar-subquery")


@settings(max_examples=6, deadline=None)
@given(
    data=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9), st.integers(0, 60)), max_size=30),
    size=st.integers(1, 4),
    offset=st.integers(0, 4),
    delay=st.integers(0, 6),
)
def test_pairs_equal_a_plain_scan(spark, data, size, offset, delay):
    """Windows of ``size`` slides of 5 seconds; every pair judged on its own."""
    windows = Windows(f"{5 * size} seconds", "5 seconds", f"{offset} seconds")
    seen = running_max(data)
    pairs, late = set(), set()
    for i, (_, _, s) in enumerate(data):
        newest = s - (s - offset) % 5
        starts = [newest - 5 * j for j in range(size)]
        open_ = [w for w in starts if seen[i] is None or w + 5 * size > seen[i] - delay]
        pairs |= {(i, at(w)) for w in open_}
        if not open_:
            late.add(i)
    df = arrivals(spark, data)
    got = on_time_pairs(df, windows, f"{delay} seconds", chunks=4)
    assert {(r.row_id, r.start) for r in got.select("row_id", "window.start").collect()} == pairs
    assert {r.row_id for r in split_late(df, windows, f"{delay} seconds", chunks=4)[1].collect()} == late


def test_rows_without_a_source_are_one_source(spark):
    df = spark.range(200).selectExpr(
        "if(id % 4 = 0, null, id % 2) source_partition", "id row_id", "id + if(id % 7 = 0, 40, 0) arrival",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) ts",
    )
    named = df.selectExpr("coalesce(source_partition, 9) source_partition", "row_id", "arrival", "ts")
    windows = Windows("4 seconds", "2 seconds")
    on_time, late = split_late(df, windows)
    assert on_time.count() + late.count() == 200 and late.where("source_partition is null").count() > 0
    assert rows(late.select("row_id"), "row_id") == rows(split_late(named, windows)[1].select("row_id"), "row_id")
