"""Bounded sources: a table's files read as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from windrow.functions.times import arrival_now


def table_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = 1
) -> DataFrame:
    """A stream over the parquet files of ``folder``, oldest first, from the first one on; ``None``
    takes all there are in one batch.

    Replayable: offsets live in the checkpoint of the query that reads it.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """A stream of text lines (``value``); ``\\n`` ends a line, a ``\\r`` before it is dropped."""
    raw = (
        spark.readStream.option("lineSep", "\n")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
    )
    return raw.select(F.regexp_replace("value", r"\r\z", "").alias("value"))


def event_time(df: DataFrame, ts: Column | str, delay: str, name: str = "ts") -> DataFrame:
    """Give a stream its event time and watermark.

    ``ts`` may be any time column; a watermark needs TIMESTAMP, so others are read as UTC.  Derive
    or shift the time here: after ``withWatermark`` arithmetic on the column loses the watermark.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    return df.withColumn(name, column.cast("timestamp")).withWatermark(name, delay)


def by_clock(df: DataFrame, delay: str, name: str, beats_per_second: int = 1) -> DataFrame:
    """Give a stream its time of ingest as event time, and a clock that goes on while it is silent.

    A heartbeat joins the stream, moves the watermark and is dropped again, so that a window of the
    clock is emitted when the clock has passed it, whether or not more rows come.
    """
    beat = df.sparkSession.readStream.format("rate").option("rowsPerSecond", beats_per_second).load()
    beats = beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit(True).alias("_beat"))
    timed = event_time(df.withColumn("_beat", F.lit(False)).unionByName(beats), arrival_now(), delay, name)
    # The condition names the event time too, which is never so early: else the optimizer would move it
    # below the watermark, which would then not see the beats.
    return timed.where(~F.col("_beat") | (F.unix_micros(name) < 0)).drop("_beat")
