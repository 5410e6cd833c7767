"""The running jobs: a source, a plan and its sinks put together.

Each takes a stream (a topic, a replayed table, text files) and gives the writers to start; every
writer has its own checkpoint under ``checkpoints``, or under the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from windrow.functions.text import line_word_counts
from windrow.functions.times import from_epoch_millis
from windrow.operators.publish import publish_records, wire_fields
from windrow.operators.totals import fanned_stream
from windrow.operators.windows import (
    NAME_WINDOWS,
    NO_DELAY,
    READING_WINDOWS,
    RETAIL_DELAY,
    RETAIL_WINDOWS,
    ROLLUP_WINDOWS,
    WORD_WINDOWS,
    Windows,
)
from windrow.plans import names, readings, retail, words
from windrow.schemas import TRANSACTION
from windrow.session import shared_dir
from windrow.sources.kafka import write_topic
from windrow.sources.replay import by_clock, event_time
from windrow.streaming import sinks
from windrow.streaming.clock import clock_sums
from windrow.streaming.late import late_split, pair_split
from windrow.streaming.reduce import halved_stream


#: How long a total may be delivered again and still be told from a new one.
REPEATS_WITHIN = "30 seconds"


def checkpoint_of(df: DataFrame, name: str, checkpoints: str | None = None) -> str:
    return f"{checkpoints or shared_dir(df.sparkSession) + '/checkpoints'}/{name}"


def start_all(writers: Iterable[DataStreamWriter]) -> list[StreamingQuery]:
    return [writer.start() for writer in writers]


def publish(
    transactions: DataFrame, out: str | dict[str, str], timestamp: Column | str = "ts"
) -> None:
    """Write a table of transactions as keyed records, numbered by ``transaction_id``, to a folder or
    a topic."""
    records = publish_records(transactions, "transaction_id", wire_fields(TRANSACTION), timestamp)
    if isinstance(out, dict):
        records.write.format("kafka").options(**out).save()
    else:
        records.write.mode("append").parquet(out)


def retail_job(
    records: DataFrame,
    out: str | dict[str, str],
    windows: Windows = RETAIL_WINDOWS,
    partitions: int | None = None,
    checkpoints: str | None = None,
    sink: sinks.Sink = sinks.printed,
) -> list[DataStreamWriter]:
    """Transaction records to product totals, for ``sink``, and store totals as topic records.

    ``out`` is a folder or the options of a topic.  With ``partitions`` the records are dealt round
    robin over that many target partitions.  Results are printed unless another ``sink`` is given,
    here and below.
    """
    transactions = retail.transactions_of(records)
    products = retail.product_totals(transactions, windows)
    stores = retail.store_records(transactions, windows)
    return [
        sink(products, checkpoint_of(records, "product-totals", checkpoints)),
        _published(stores, out, partitions, checkpoint_of(records, "store-totals", checkpoints)),
    ]


def fanned_job(
    records: DataFrame,
    stores: Callable[[DataFrame, int], None],
    products: Callable[[DataFrame, int], None],
    windows: Windows = RETAIL_WINDOWS,
    checkpoints: str | None = None,
) -> DataStreamWriter:
    """Transaction records to store totals and product totals, by one query that reads them once.

    Both sinks get their rows (``window_start, window_end, key, sum_amount, tran_count``) of a batch before it
    is committed; bodies of repeatable effect, such as :func:`sinks.batch_folder`, make that exactly once.
    """
    totals = fanned_stream(retail.transactions_of(records), windows, {"store": "store_id", "product": "product_id"}, "price")
    return sinks.batches(totals, sinks.by_branch({"store": stores, "product": products}), checkpoint_of(records, "fanned", checkpoints))


def pair_job(
    arrivals: DataFrame,
    totals: Callable[[DataFrame, int], None],
    late: Callable[[DataFrame, int], None],
    key: str,
    amount: str,
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    checkpoints: str | None = None,
    **order: str,
) -> DataStreamWriter:
    """Totals of what came in time for its window, and the pairs of a row and a window that did not."""
    body = pair_split(checkpoint_of(arrivals, "pairs-open", checkpoints), totals, late, key, amount, windows, delay, **order)
    return sinks.batches(arrivals, body, checkpoint_of(arrivals, "pairs", checkpoints))


def rollup_job(
    records: DataFrame,
    writer: sinks.LifecycleWriter,
    windows: Windows = ROLLUP_WINDOWS,
    by_clock: bool = True,
    delay: str = REPEATS_WITHIN,
    checkpoints: str | None = None,
    repeats: bool = True,
    amount: str = "double",
) -> DataStreamWriter:
    """Store-total records to the global roll-up, handed row by row to ``writer``.

    ``by_clock`` windows by the time of ingest; otherwise by the window times in the records.  A total
    that is delivered again within ``delay`` counts once; windows come out so much later.
    """
    rolled = retail.rollup_of_records(records, windows, delay=delay, repeats=repeats, clock=by_clock, amount=amount)
    return sinks.rows_to(rolled, writer, checkpoint_of(records, "rollup", checkpoints))


def split_job(
    arrivals: DataFrame,
    main: Callable[[DataFrame, int], None],
    side: Callable[[DataFrame, int], None],
    windows: Windows = RETAIL_WINDOWS,
    delay: str = RETAIL_DELAY,
    checkpoints: str | None = None,
    **order: str,
) -> DataStreamWriter:
    """Rows to a main output, rows late for all their windows to a side output, batch by batch."""
    seen = checkpoint_of(arrivals, "split-seen", checkpoints)
    body = late_split(seen, main, side, windows, delay, **order)
    return sinks.batches(arrivals, body, checkpoint_of(arrivals, "split", checkpoints))


def word_job(
    lines: DataFrame, windows: Windows = WORD_WINDOWS, checkpoints: str | None = None, sink: sinks.Sink = sinks.printed, timers: bool = False
) -> DataStreamWriter:
    """Text lines (``value``) to word counts per window of their ingest.  With ``timers``, here and below, windows
    are handed out by timers in the state and not by a heartbeat beside the input."""
    if timers:
        counted = clock_sums(line_word_counts(lines.select(F.col("value").alias("line"))), windows, "word", "n", "n")
        return sink(counted, checkpoint_of(lines, "words", checkpoints))
    stamped = by_clock(lines.select(F.col("value").alias("line")), NO_DELAY, "ts")
    counts = words.word_totals(stamped, windows)
    return sink(counts, checkpoint_of(lines, "words", checkpoints))


def name_job(
    units: DataFrame, windows: Windows = NAME_WINDOWS, checkpoints: str | None = None, sink: sinks.Sink = sinks.printed, timers: bool = False
) -> DataStreamWriter:
    """Named units (``name``, ``n``) summed per name and window of their ingest."""
    if timers:
        return sink(clock_sums(units, windows, "name", "n", "n"), checkpoint_of(units, "names", checkpoints))
    stamped = by_clock(units.select("name", "n"), NO_DELAY, "arrival_ts")
    return sink(names.name_sums(stamped, windows), checkpoint_of(units, "names", checkpoints))


def reading_job(
    rows: DataFrame,
    windows: Windows = READING_WINDOWS,
    clock: bool = True,
    checkpoints: str | None = None,
    sink: sinks.Sink = sinks.printed,
    timers: bool = False,
) -> DataStreamWriter:
    """Readings (``timestamp`` in epoch milliseconds, ``sensorId``, ``temperature``) halved per
    sensor and window.  Within one instant of arrival they go by ``timestamp``.  With ``timers`` the state is
    cut by rows as well."""
    if timers:
        timed = rows if clock else event_time(rows, from_epoch_millis("timestamp"), NO_DELAY)
        halved = halved_stream(timed, windows, "sensorId", tiebreak="timestamp", stamp="timestamp", by_clock=clock)
        return sink(halved, checkpoint_of(rows, "readings", checkpoints))
    stamped = by_clock(rows, NO_DELAY, "ts") if clock else event_time(rows, from_epoch_millis("timestamp"), NO_DELAY)
    reduced = readings.halved_readings(
        stamped, windows, key="sensorId", tiebreak="timestamp", stamp="timestamp"
    )
    return sink(reduced, checkpoint_of(rows, "readings", checkpoints))


def _published(
    records: DataFrame, out: str | dict[str, str], partitions: int | None, checkpoint: str
) -> DataStreamWriter:
    to_topic = isinstance(out, dict)
    if partitions is None:
        return (write_topic if to_topic else sinks.files)(records, out, checkpoint)
    body = sinks.topic_batch(out) if to_topic else sinks.batch_folder(out)
    return sinks.batches(records, sinks.dealt(body, partitions), checkpoint)
