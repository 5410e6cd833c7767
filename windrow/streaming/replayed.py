"""Queries that replay a given table as a stream, to its end, and hand back what was emitted.

Each run lays the table out as files in the order of its time or arrival, reads them one batch each,
and keeps output and state in a folder of its own under the shared folder.  What it emitted is
checkpointed, and the folder removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructField, StructType, TimestampType

from windrow.functions.text import explode_lines
from windrow.functions.times import epoch_micros
from windrow.operators.rollup import merged_rollup, placed_rollup, shown_rollup, window_time
from windrow.operators.totals import branched, merged_totals, placed_totals, shown_totals
from windrow.operators.windows import NO_DELAY, RETAIL_DELAY, WORD_WINDOWS
from windrow.plans import names, readings, retail, words
from windrow.plans.catalog import ARRIVAL_ORDER, DAYS, LATE_WINDOWS, MONTHS, NAMES, ROLLUP, SALES_WINDOWS, STAGGER, published
from windrow.schemas import BY_STORE, TOPIC_RECORD
from windrow.session import date_in_order, pin_utc, remove_folder, shared_dir, stream_settings
from windrow.sources import tables
from windrow.sources.offsets import record_stream
from windrow.sources.records import decode_by_store, decode_transactions, encode_by_store
from windrow.sources.replay import event_time, table_stream
from windrow.streaming import jobs, sinks
from windrow.streaming.closing import closing, once
from windrow.streaming.late import open_totals, summed
from windrow.streaming.reduce import halved_stream
from windrow.streaming.runs import append_end_marker, append_end_record, drain
from windrow.streaming.stagger import staggered_totals
from windrow.streaming.transactional import committed, transactional

# Files, and so batches, that a table is replayed in at least, the rows of a file on average at most, the bytes of
# its texts, and the files of a batch at most.  A file is read by one task.
LEAST_FILES, FILE_ROWS, FILE_BYTES, BATCH_FILES = 4, 250_000, 16_000_000, 64


def store_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the windows a stream over the sales has closed by their end."""
    run, kind = _store_totals(spark, folder, flush=False)
    return run.ended(f"{run.folder}/out", kind)


def flushed_store_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The same, and after the end marker those of the windows that were still open: all there are."""
    run, kind = _store_totals(spark, folder)
    return run.ended(f"{run.folder}/out", kind)


def _store_totals(spark: SparkSession, folder: str, flush: bool = True) -> tuple[_Run, StructType]:
    """A run that has written the store totals of closed windows, and their layout."""
    run, key = _Run(spark), ["store_id"]
    sales = run.stream(_view(spark, folder, "lineitem", tables.sales), epoch_micros("ts"))
    kind = run.closes(
        sales,
        lambda df: placed_totals(df, SALES_WINDOWS, key, "price"),
        lambda df: merged_totals(df, key),
        lambda df: shown_totals(df, key),
        RETAIL_DELAY,
        (lambda: append_end_marker(sales, run.input)) if flush else None,
    )
    return run, kind


def rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The roll-up of per-store totals that come through a topic, each of them twice."""
    run = _Run(spark)
    totals = retail.amount_totals(_view(spark, folder, "lineitem", tables.sales), SALES_WINDOWS, "store_id", "price", exact=True)
    totals.write.parquet(f"{run.folder}/totals")  # the layout reads them more than once
    totals = spark.read.schema(totals.schema).parquet(f"{run.folder}/totals")
    records = encode_by_store(totals).select("key", F.lit(0).alias("partition"), F.current_timestamp().alias("timestamp"), "value")
    order = F.element_at(F.split("key", "@"), 2).cast("bigint")  # the window that the key names
    twice = records.unionByName(records)
    topic = run.stream(twice, order, TOPIC_RECORD)
    kind = run.closes(
        window_time(decode_by_store(topic, "decimal(28,2)")),
        lambda df: placed_rollup(df, ROLLUP),
        merged_rollup,
        shown_rollup,
        "20 days",
        lambda: append_end_record(spark, run.input, BY_STORE, ["windowStart", "windowEnd"]),
        repeats=["store_id", "window_start", "window_end"],
    )
    return run.ended(f"{run.folder}/out", kind)


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The side output of a stream that splits off rows late for all their windows."""
    run = _Run(spark)
    arrivals = run.stream(_view(spark, folder, "events", tables.shuffled_arrivals), F.col("arrival"), then=F.col("row_id"))
    drain(
        jobs.split_job(
            arrivals,
            sinks.batch_folder(f"{run.folder}/main"),
            sinks.batch_folder(f"{run.folder}/side"),
            LATE_WINDOWS,
            RETAIL_DELAY,
            f"{run.folder}/checkpoints",
            **ARRIVAL_ORDER,
        )
    )
    return run.ended(f"{run.folder}/side", arrivals.schema)


def name_sums(spark: SparkSession, folder: str) -> DataFrame:
    run = _Run(spark)
    units = run.stream(_view(spark, folder, "events", tables.named_units), epoch_micros("arrival_ts"))
    sums = names.name_sums(event_time(units, "arrival_ts", NO_DELAY, "arrival_ts"), NAMES)
    return run.emitted(sums, lambda: append_end_marker(units, run.input, "arrival_ts"))


def word_totals(spark: SparkSession, folder: str) -> DataFrame:
    run = _Run(spark)
    texts = run.stream(_view(spark, folder, "documents", tables.texts).select("ts", "text"), epoch_micros("ts"))
    placed = lambda df: words.placed_words(explode_lines(df), WORD_WINDOWS)
    kind = run.closes(texts, placed, words.merged_words, lambda df: df, NO_DELAY, lambda: append_end_marker(texts, run.input))
    return run.ended(f"{run.folder}/out", kind)


def halved_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Kept by whole windows: by panes, which a hot sensor needs, the last bit may differ."""
    run = _Run(spark)
    rows = run.stream(_view(spark, folder, "events", tables.readings), F.col("reading_id"))
    halved = readings.halved_readings(event_time(rows, "ts", NO_DELAY), DAYS, pane=DAYS.size)
    return run.emitted(halved, lambda: append_end_marker(rows, run.input))


def _pairs(spark: SparkSession, folder: str) -> tuple[_Run, str]:
    run = _Run(spark)
    view = _view(spark, folder, "events", tables.shuffled_arrivals).withColumn("price", F.col("price").cast(tables.MONEY))
    arrivals = run.stream(view, F.col("arrival"), then=F.col("row_id"))
    out = [sinks.batch_folder(f"{run.folder}/{name}") for name in ("totals", "late")]
    checkpoints = f"{run.folder}/checkpoints"
    drain(jobs.pair_job(arrivals, *out, "store_id", "price", LATE_WINDOWS, RETAIL_DELAY, checkpoints, **ARRIVAL_ORDER))
    return run, f"{checkpoints}/pairs-open"


def on_time_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the pairs that came in time: of windows that went out, and of those open at the end."""
    run, kept = _pairs(spark, folder)
    still_open = open_totals(spark, kept)
    out = _batches(spark, f"{run.folder}/totals", still_open.schema)
    return run.closed(summed(out.unionByName(still_open), "store_id"))


def late_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs that came after their window had closed."""
    run, _ = _pairs(spark, folder)
    layout = StructType.fromDDL("row_id bigint, window_start timestamp, window_end timestamp")
    return run.closed(_batches(spark, f"{run.folder}/late", layout))


def fanout_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Store and product totals, by one query with one read and one table of open windows, as two outputs."""
    run = _Run(spark)
    sales = run.stream(_view(spark, folder, "lineitem", tables.sales), epoch_micros("ts"))
    branches, key = {"store_id": "store_id", "product_id": "product_id"}, ["branch", "key"]
    outputs = {k: sinks.batch_folder(f"{run.folder}/{k}") for k in branches}

    def emit(totals: DataFrame, batch_id: int) -> None:
        # each branch is summed up for its own output, so nothing is held
        for name, body in outputs.items():
            body(totals.where(F.col("branch") == name).drop("branch"), batch_id)

    kind = run.closes(
        sales,
        lambda df: placed_totals(branched(df, branches, ["ts", "price"]), SALES_WINDOWS, key, "price"),
        lambda df: merged_totals(df, key),
        lambda df: shown_totals(df, key),
        RETAIL_DELAY,
        lambda: append_end_marker(sales, run.input),
        emit=emit,
    )
    plain = StructType([f for f in kind if f.name != "branch"])
    found = [_batches(spark, f"{run.folder}/{k}", plain).withColumn("branch", F.lit(k)) for k in branches]
    return run.closed(found[0].unionByName(found[1]))


def from_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Events as records of three topic partitions, read by their offsets: what there is, then twice, by the same
    query started again, what has come since."""
    run = _Run(spark)
    records = published(spark, folder).select("key", "partition", "timestamp", F.col("value").cast("binary").alias("value"))
    stream = decode_transactions(record_stream(spark, run.input, StructType([TOPIC_RECORD["value"]])))
    writer = sinks.files(stream, f"{run.folder}/out", f"{run.folder}/checkpoint")
    for turn in range(3):
        part = records.where(F.pmod(F.xxhash64("key"), F.lit(3)) == turn)
        part.repartition("partition").write.mode("append").partitionBy("partition").parquet(run.input)
        drain(writer)
    return run.ended(f"{run.folder}/out", stream.schema)


def published_once(spark: SparkSession, folder: str) -> DataFrame:
    """Store totals through the sink of two phases, as its readers see them: a second query takes there what the
    first has written."""
    run, kind = _store_totals(spark, folder)
    totals = table_stream(spark, f"{run.folder}/out", kind, BATCH_FILES).select(kind.fieldNames())
    run.to_the_end(transactional(totals, f"{run.folder}/published", f"{run.folder}/published-checkpoint"))
    return run.closed(committed(spark, f"{run.folder}/published", kind))


def halved_long(spark: SparkSession, folder: str) -> DataFrame:
    """All readings as one sensor's, by month: groups of many runs, in a state cut by rows."""
    run = _Run(spark)
    one = _view(spark, folder, "events", tables.readings).withColumn("sensor_id", F.lit("all"))
    rows = run.stream(one, F.col("reading_id"))
    return run.emitted(halved_stream(event_time(rows, "ts", NO_DELAY), MONTHS), lambda: append_end_marker(rows, run.input))


def staggered_store_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of windows whose phase is the store's own, fixed by its first rows on the stream."""
    run = _Run(spark)
    view = _view(spark, folder, "events", tables.shuffled_arrivals)
    sales = run.stream(view.select("ts", "store_id", F.col("price").cast(tables.MONEY).alias("price")), epoch_micros("ts"))
    totals = staggered_totals(event_time(sales, "ts", NO_DELAY), STAGGER, "store_id", "price")
    return run.emitted(totals, lambda: append_end_marker(sales, run.input))


REPLAYS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_stream_store_sliding": store_totals,
    "q_stream_flushed_store_sliding": flushed_store_totals,
    "q_stream_rollup": rollup,
    "q_stream_late_rows": late_rows,
    "q_stream_name_sum": name_sums,
    "q_stream_wordcount_window": word_totals,
    "q_stream_reading_halving": halved_readings,
    "q_stream_on_time_store_sliding": on_time_totals,
    "q_stream_late_pairs": late_pairs,
    "q_stream_fanout_totals": fanout_totals,
    "q_stream_published_once": published_once,
    "q_stream_topic_offsets": from_offsets,
    "q_stream_reading_halving_long": halved_long,
    "q_stream_tumbling_stagger": staggered_store_totals,
}


def _view(spark: SparkSession, folder: str, name: str, view: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return view(tables.table(pin_utc(spark), folder, name))


def _batches(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """What a sink has written, without the numbers of the batches."""
    plain = StructType([StructField(f.name, f.dataType) for f in schema])
    return spark.read.schema(plain).parquet(folder).select(plain.fieldNames())


class _Run:
    """One replay and its folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/replays/{uuid4()}"
        self.input = f"{self.folder}/in"

    def stream(self, rows: DataFrame, order: Column, schema: StructType | None = None, then: Column | None = None) -> DataFrame:
        """The rows as a stream of files in the order of a number: the oldest rows in the oldest file.

        One job lays them out, cut by ranges of (``order``, ``then``), rows without a number first.  ``then`` is a
        hash of the row unless rows of one number have an order of their own, so an instant of any number
        of rows is spread over as many files as it fills.
        """
        # Streams carry TIMESTAMP, so files do too.
        rows = rows.select(
            *[F.col(f.name).cast("timestamp") if f.dataType.simpleString() == "timestamp_ntz" else F.col(f.name) for f in rows.schema]
        )
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if f.dataType.simpleString() in ("string", "binary")]
        count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(texts, F.lit(0)).cast("bigint")), F.lit(0))).first()
        files = max(LEAST_FILES, -(-count // FILE_ROWS), -(-size // FILE_BYTES))
        minor = F.xxhash64(*rows.columns) if then is None else then
        rows.repartitionByRange(files, order.asc_nulls_first(), minor).write.parquet(self.input)
        date_in_order(self.spark, self.input)
        per_batch = min(BATCH_FILES, files // LEAST_FILES)
        return table_stream(self.spark, self.input, schema or rows.schema, per_batch)

    def closes(
        self,
        rows: DataFrame,
        parts: Callable[[DataFrame], DataFrame],
        merged: Callable[[DataFrame], DataFrame],
        shown: Callable[[DataFrame], DataFrame],
        delay: str,
        end: Callable[[], None] | None = None,
        repeats: Sequence[str] | None = None,
        emit: Callable[[DataFrame, int], None] | None = None,
    ) -> StructType:
        """Has the totals of windows go to ``emit``, or to the folder ``out``, as they are closed, see
        :func:`windrow.streaming.closing.closing`; returns their layout.  Rows that come again with the same
        ``repeats`` count once."""
        sink = emit or sinks.batch_folder(f"{self.folder}/out")
        body = closing(f"{self.folder}/open", lambda totals, i: sink(shown(totals), i), parts, merged, delay)
        if repeats is not None:
            body = once(f"{self.folder}/seen", body, repeats, delay)
        self.to_the_end(sinks.batches(rows, body, f"{self.folder}/checkpoint"), end)
        return shown(merged(parts(rows))).schema

    def emitted(self, result: DataFrame, end: Callable[[], None] | None = None) -> DataFrame:
        """What the stream has emitted at the end of its input, and of what ``end`` adds to it."""
        self.to_the_end(sinks.files(result, f"{self.folder}/out", f"{self.folder}/checkpoint"), end)
        return self.ended(f"{self.folder}/out", result.schema)

    def to_the_end(self, writer: DataStreamWriter, end: Callable[[], None] | None = None) -> None:
        with stream_settings(self.spark):
            drain(writer)
            if end is not None:
                end()
                drain(writer)

    def ended(self, output: str, schema: StructType) -> DataFrame:
        """The rows written, with times as the tables have them."""
        return self.closed(_batches(self.spark, output, schema))

    def closed(self, rows: DataFrame) -> DataFrame:
        """The rows with times as the tables have them, kept beyond the run's folder."""
        back = [F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, TimestampType) else F.col(f.name) for f in rows.schema]
        kept = _checkpointed(rows.select(*[c.alias(f.name) for c, f in zip(back, rows.schema, strict=True)]))
        remove_folder(self.spark, self.folder)
        return kept


def _checkpointed(rows: DataFrame) -> DataFrame:
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint()
