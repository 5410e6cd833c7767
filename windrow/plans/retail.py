"""Transactions to totals per store and per product, and on to a global roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from windrow.functions.times import from_epoch_millis
from windrow.operators.rollup import global_rollup, window_time
from windrow.operators.totals import amount_totals, fanned_totals
from windrow.operators.windows import NO_DELAY, RETAIL_DELAY, RETAIL_WINDOWS, ROLLUP_WINDOWS, Windows
from windrow.sources.records import decode_by_store, decode_transactions, encode_by_store
from windrow.sources.replay import by_clock, event_time


def transactions_of(records: DataFrame, delay: str = RETAIL_DELAY) -> DataFrame:
    """Decoded transactions with event time ``ts`` and its watermark, from topic records."""
    decoded = decode_transactions(records)
    return event_time(decoded, from_epoch_millis("timestamp"), delay)


def store_totals(
    transactions: DataFrame, windows: Windows = RETAIL_WINDOWS, amount: str = "price"
) -> DataFrame:
    return amount_totals(transactions, windows, "store_id", amount)


def product_totals(
    transactions: DataFrame, windows: Windows = RETAIL_WINDOWS, amount: str = "price"
) -> DataFrame:
    return amount_totals(transactions, windows, "product_id", amount)


def fan_out(
    transactions: DataFrame, windows: Windows = RETAIL_WINDOWS
) -> tuple[DataFrame, DataFrame]:
    """``(by_store, by_product)`` over one source; as streams, two queries with a checkpoint each."""
    return store_totals(transactions, windows), product_totals(transactions, windows)


def fanned_out(transactions: DataFrame, windows: Windows = RETAIL_WINDOWS, amount: str = "price") -> DataFrame:
    """Both branches of a batch table's fan-out in one pass over it."""
    return fanned_totals(transactions, windows, ["store_id", "product_id"], amount)


def store_records(transactions: DataFrame, windows: Windows = RETAIL_WINDOWS) -> DataFrame:
    """What the first stage publishes: per-store totals as keyed topic records, to the last digit."""
    return encode_by_store(amount_totals(transactions, windows, "store_id", "price", exact=True))


def rollup_of_records(
    records: DataFrame,
    windows: Windows = ROLLUP_WINDOWS,
    ts: Column | str = "ts",
    delay: str = NO_DELAY,
    repeats: bool = False,
    clock: bool = False,
    amount: str = "double",
) -> DataFrame:
    """The second stage: per-store topic records to the global roll-up.

    The event time is the window time carried in the record, which makes the result reproducible;
    ``delay`` then has to cover the span of windows one batch of the first stage publishes, since
    its files come in any order.  With ``clock`` a stream goes by the time of ingest instead.  With
    ``repeats`` a (store, window) total that comes again within the delay counts once, as it may from
    a sink that delivers at least once.  ``amount`` is the type in which the sums are read and summed
    up again; see :func:`windrow.sources.records.decode_by_store`.
    """
    decoded = window_time(decode_by_store(records, amount))
    totals = by_clock(decoded, delay, "ts") if clock else event_time(decoded, ts, delay)
    if repeats:
        totals = _once(totals, ["store_id", "window_start", "window_end"])
    return global_rollup(totals, windows)


def _once(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def rollup_in_one(
    transactions: DataFrame,
    windows: Windows = RETAIL_WINDOWS,
    rollup: Windows = ROLLUP_WINDOWS,
    amount: str = "price",
) -> DataFrame:
    """Both stages in one query, batch or stream."""
    totals = amount_totals(transactions, windows, "store_id", amount, time_name="ts", exact=True)
    return global_rollup(totals, rollup)
