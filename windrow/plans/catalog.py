"""One batch query per operator over the given tables.

The tables span days and years where a live stream spans seconds, so windows here are hours and
days long; the seconds are the defaults of the API.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from windrow.functions.text import explode_lines, line_word_counts
from windrow.functions.times import from_epoch_millis
from windrow.operators.halving import halving_reduce
from windrow.operators.lateness import closed_windows, flag_late, on_time_pairs, split_late
from windrow.operators.publish import publish_records, round_robin, wire_fields
from windrow.operators.stagger import staggered
from windrow.operators.totals import amount_totals, pair_totals, windowed_aggregates
from windrow.operators.windows import RETAIL_DELAY, WORD_WINDOWS, Windows
from windrow.plans import names, retail, words
from windrow.schemas import TRANSACTION
from windrow.session import pin_utc
from windrow.sources import records, tables

Query = Callable[[SparkSession, str], DataFrame]

SALES_WINDOWS = Windows("10 days", "5 days", "2 days")
ROLLUP = Windows("5 days")
NAMES = Windows("3 hours")
DAYS = Windows("1 day")
MONTHS = Windows("30 days")
LATE_WINDOWS = Windows("2 hours", "1 hour")
STAGGER = "6 hours"

TRANSACTION_FIELDS = TRANSACTION.fieldNames()
ARRIVAL_ORDER = {"source": "source_partition", "arrival": "arrival", "tiebreak": "row_id"}


def _table(name: str, view: Callable[[DataFrame], DataFrame]):
    def load(spark: SparkSession, folder: str) -> DataFrame:
        return view(tables.table(pin_utc(spark), folder, name))

    return load


_sales = _table("lineitem", tables.sales)
_net_sales = _table("lineitem", tables.net_sales)
_transactions = _table("events", tables.transactions)
_units = _table("events", tables.named_units)
_readings = _table("events", tables.readings)
_arrivals = _table("events", tables.shuffled_arrivals)
_texts = _table("documents", tables.texts)


def _plain(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def tx_view(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder).select(*TRANSACTION_FIELDS)


def store_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return retail.store_totals(_sales(spark, folder), SALES_WINDOWS)


def product_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return retail.product_totals(_sales(spark, folder), SALES_WINDOWS)


def fanout_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Both branches of the fan-out, window by window; ``key`` is the store or the product."""
    key = F.when(F.col("branch") == "store_id", F.col("store_id")).otherwise(F.col("product_id"))
    fanned = retail.fanned_out(_sales(spark, folder), SALES_WINDOWS)
    return fanned.select("branch", "window_start", "window_end", key.alias("key"), "sum_amount", "tran_count")


def store_net_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return retail.store_totals(_net_sales(spark, folder), SALES_WINDOWS)


def net_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return retail.rollup_in_one(_net_sales(spark, folder), SALES_WINDOWS, ROLLUP)


def global_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return retail.rollup_in_one(_sales(spark, folder), SALES_WINDOWS, ROLLUP)


def name_sum(spark: SparkSession, folder: str) -> DataFrame:
    return names.name_sums(_units(spark, folder), NAMES)


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "line")


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(explode_lines(_texts(spark, folder).select("doc_id", "text")))


def line_words(spark: SparkSession, folder: str) -> DataFrame:
    return line_word_counts(_numbered(explode_lines(_texts(spark, folder).select("doc_id", "text"))))


def wordcount_window(spark: SparkSession, folder: str) -> DataFrame:
    return words.text_word_totals(_texts(spark, folder), WORD_WINDOWS)


def reading_halving(spark: SparkSession, folder: str) -> DataFrame:
    return halving_reduce(_readings(spark, folder), DAYS)


def published(spark: SparkSession, folder: str) -> DataFrame:
    return publish_records(_transactions(spark, folder), "transaction_id", wire_fields(TRANSACTION))


def decoded_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events published as topic records and read back."""
    return records.decode_transactions(published(spark, folder))


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose event time is a field of theirs, per hour of that time."""
    decoded = records.decode_transactions(published(spark, folder))
    timed = decoded.select(_plain(from_epoch_millis("timestamp")).alias("ts"), "transaction_id")
    first, last = F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    return windowed_aggregates(timed, Windows("1 hour"), [], [first, last, F.count(F.lit(1)).alias("n")], "ts")


def window_all(spark: SparkSession, folder: str) -> DataFrame:
    """Aggregates of one's own over all rows of a window, whatever their key."""
    own = [
        F.max("price").cast("double").alias("highest"),
        F.min("price").cast("double").alias("lowest"),
        F.count_distinct("store_id").alias("stores"),
        F.max_by("product_id", F.struct("price", "product_id")).alias("dearest"),
    ]
    return windowed_aggregates(_sales(spark, folder), SALES_WINDOWS, [], own, "ts")


def by_store_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    wire = records.encode_by_store(store_sliding(spark, folder))
    decoded = records.decode_by_store(wire)
    return decoded.withColumns(
        {"window_start": _plain("window_start"), "window_end": _plain("window_end")}
    )


def product_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Product totals as topic records and back, their sums to the last digit."""
    totals = amount_totals(_sales(spark, folder), SALES_WINDOWS, "product_id", "price", exact=True)
    decoded = records.decode_by_product(records.encode_by_product(totals), "decimal(28,2)")
    plain = {"window_start": _plain("window_start"), "window_end": _plain("window_end"), "sum_amount": F.col("sum_amount").cast("double")}
    return decoded.withColumns(plain)


def published_records(spark: SparkSession, folder: str) -> DataFrame:
    """Published records with their value decoded (JSON text differs by float formatting)."""
    topic = published(spark, folder).withColumnRenamed("timestamp", "record_ts")
    decoded = records.decode_transactions(topic, keep=("key", "partition", "record_ts"))
    return decoded.withColumn("record_ts", _plain("record_ts"))


def round_robin_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows dealt over three targets by seven tasks, each of which begins one target further: what every
    target gets from each.  The tasks are made of stated rows, so that the counts are known."""
    by_task = _sales(spark, folder).select((F.col("product_id") % 7).cast("int").alias("task")).repartitionById(7, F.col("task"))
    dealt = by_task.select("task", round_robin(3).alias("target"))
    return dealt.groupBy("task", "target").agg(F.count(F.lit(1)).alias("n"))


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    _, late = split_late(_arrivals(spark, folder), LATE_WINDOWS, RETAIL_DELAY, **ARRIVAL_ORDER)
    return late.select("row_id", "ts", "source_partition", "arrival", "store_id", "price")


def on_time_store_sliding(spark: SparkSession, folder: str) -> DataFrame:
    pairs = on_time_pairs(_arrivals(spark, folder), LATE_WINDOWS, RETAIL_DELAY, **ARRIVAL_ORDER)
    return pair_totals(pairs, "store_id", F.col("price").cast(tables.MONEY))


def closed_store_windows(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("price").cast(tables.MONEY)
    rows = _transactions(spark, folder).select("ts", "store_id", price.alias("price"))
    return closed_windows(amount_totals(rows, DAYS, "store_id", "price"), rows)


def reading_halving_long(spark: SparkSession, folder: str) -> DataFrame:
    """All readings as one sensor's, by month: groups of many runs."""
    one = _readings(spark, folder).withColumn("sensor_id", F.lit("all"))
    return halving_reduce(one, MONTHS, split_above=5_000)


def late_rows_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Late and on-time rows where one of the sources has no name."""
    rows = _arrivals(spark, folder).withColumn("source_partition", F.nullif("source_partition", F.lit(2)))
    flagged = flag_late(rows, LATE_WINDOWS, RETAIL_DELAY, **ARRIVAL_ORDER)
    return flagged.select("row_id", F.coalesce("source_partition", F.lit(-1)).alias("source"), "late")


def stagger_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Staggered windows where one of the keys has no name."""
    store = F.nullif(F.col("store_id") - 1, F.lit(7))
    rows = _arrivals(spark, folder).select("ts", store.alias("store"), "price")
    totals = pair_totals(staggered(rows, STAGGER, "store"), "store", F.col("price").cast(tables.MONEY))
    return totals.withColumn("store", F.coalesce("store", F.lit(-1)))


def tumbling_stagger(spark: SparkSession, folder: str) -> DataFrame:
    rows = _arrivals(spark, folder).select("ts", "store_id", "price")
    return pair_totals(staggered(rows, STAGGER, "store_id"), "store_id", F.col("price").cast(tables.MONEY))


QUERIES: dict[str, Query] = {
    "q_tx_view": tx_view,
    "q_store_sliding": store_sliding,
    "q_product_sliding": product_sliding,
    "q_fanout_totals": fanout_totals,
    "q_global_rollup": global_rollup,
    "q_store_net_sliding": store_net_sliding,
    "q_net_rollup": net_rollup,
    "q_name_sum": name_sum,
    "q_text_lines": text_lines,
    "q_line_word_counts": line_words,
    "q_wordcount_window": wordcount_window,
    "q_reading_halving": reading_halving,
    "q_decode_transactions": decoded_transactions,
    "q_event_times": event_times,
    "q_window_all": window_all,
    "q_by_store_roundtrip": by_store_roundtrip,
    "q_publish_records": published_records,
    "q_product_roundtrip": product_roundtrip,
    "q_round_robin_balance": round_robin_balance,
    "q_late_rows": late_rows,
    "q_on_time_store_sliding": on_time_store_sliding,
    "q_closed_windows": closed_store_windows,
    "q_tumbling_stagger": tumbling_stagger,
    "q_reading_halving_long": reading_halving_long,
    "q_late_rows_nulls": late_rows_nulls,
    "q_stagger_nulls": stagger_nulls,
}
