"""Totals of windows by micro-batch: what goes out, what is kept, repeats, batches tried again; layouts by bytes."""

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.compare import assert_same
from windrow.operators.totals import amount_totals, merged_totals, placed_totals, shown_totals
from windrow.operators.windows import Windows
from windrow.streaming import replayed
from windrow.streaming.closing import closing, once

START = datetime(2024, 1, 1)
SALES = "ts timestamp, store string, price decimal(18,2)"
WINDOWS = Windows("10 seconds", "5 seconds")


def at(seconds):
    return START + timedelta(seconds=seconds)


def sale(seconds, store, price=1):
    return (None if seconds is None else at(seconds), store, Decimal(price))


def store_body(folder, out, delay="2 seconds"):
    emit = lambda totals, i: shown_totals(totals, ["store"]).write.mode("overwrite").parquet(f"{out}/batch={i}")
    return closing(folder, emit, lambda df: placed_totals(df, WINDOWS, ["store"], "price"), lambda df: merged_totals(df, ["store"]), delay)


@pytest.mark.parametrize("again", [False, True])
def test_each_window_goes_out_once_and_only_open_ones_are_kept(spark, tmp_path, again):
    folder, out = str(tmp_path / "open"), str(tmp_path / "out")
    body = store_body(folder, out)
    batches = [
        [sale(i / 10, "a" if i % 3 else None, i) for i in range(400)],
        [sale(41, "a", 5), sale(3, "a", 1000), sale(None, "a", 7)],  # the second one's windows are out, the third has none
        [sale(None, "b")],
        [sale(1000, "end")],
    ]
    for i, rows in enumerate(batches):
        for _ in range(2 if again else 1):
            body(spark.createDataFrame(rows, SALES), i)
    kept = spark.read.parquet(f"{folder}/batch=0/rows") if os.path.isdir(f"{folder}/batch=0") else None
    assert kept is None and len(os.listdir(folder)) == 2  # the last one's, and that of the one before it
    first = spark.read.parquet(f"{out}/batch=0")
    assert first.agg(F.max("window_end")).first()[0] == at(35)
    in_time = [r for b in batches for r in b if r[0] is not None and r[2] != 1000 and r[1] != "end"]
    want = amount_totals(spark.createDataFrame(in_time, SALES), WINDOWS, "store", "price")
    assert_same(spark.read.parquet(out).drop("batch").toPandas(), want.toPandas())
    assert spark.read.parquet(f"{folder}/batch=3/rows").select("store").distinct().collect()[0][0] == "end"


def test_windows_that_begin_and_end_in_a_batch_are_never_kept(spark, tmp_path):
    folder = str(tmp_path / "open")
    rows = spark.range(100_000).select((F.lit(at(0)) + F.make_dt_interval(secs=F.col("id"))).alias("ts"), F.lit("a").alias("store"), F.lit(1).cast("decimal(18,2)").alias("price"))
    store_body(folder, str(tmp_path / "out"))(rows, 0)
    assert spark.read.parquet(f"{folder}/batch=0/rows").count() <= 3


def test_repeats_count_once_across_batches(spark, tmp_path):
    seen = []
    body = once(str(tmp_path / "seen"), lambda df, i: seen.append(sorted((r.store or "", r.ts) for r in df.collect())), ["store"], "10 seconds")
    none = sale(5, None)
    for i, rows in enumerate([[sale(0, "a"), sale(0, "a"), none], [sale(8, "b"), none, sale(0, "a")], [sale(100, "c")], [sale(95, "b"), sale(3, "d")]]):
        for _ in range(2):
            body(spark.createDataFrame(rows, SALES), i)
    # b is forgotten by then; d is behind the watermark
    want = [[("", at(5)), ("a", at(0))], [("b", at(8))], [("c", at(100))], [("b", at(95))]]
    assert seen == [x for w in want for x in (w, w)]


def test_a_table_of_long_texts_is_laid_out_by_bytes(spark, shared, monkeypatch):
    monkeypatch.setattr(replayed, "FILE_BYTES", 10_000)
    rows = spark.range(400).select("id", F.when(F.col("id") % 10 > 0, F.repeat(F.lit("word "), 100)).alias("text"))
    run = replayed._Run(spark)
    run.stream(rows, F.col("id"))
    assert spark.read.parquet(run.input).select(F.input_file_name()).distinct().count() == 18
    replayed.remove_folder(spark, run.folder)


@pytest.mark.parametrize("name", ["q_stream_wordcount_window", "q_stream_fanout_totals", "q_stream_flushed_store_sliding", "q_stream_rollup", "q_stream_store_sliding", "q_stream_published_once"])
def test_totals_by_window_need_no_state_store(spark, small, monkeypatch, name):
    from windrow.streaming import runs

    seen = []
    monkeypatch.setattr(replayed, "drain", lambda writer: seen.append(runs.drain(writer)))
    replayed.REPLAYS[name](spark, small)
    assert seen and not [p for query in seen for p in query.recentProgress if p["stateOperators"]]
