"""Rows as topic records: key, target partition, timestamp, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from windrow.sources.records import encode

# Fixed value: partitions of the transaction topic.
TOPIC_PARTITIONS = 3


def publish_records(
    df: DataFrame,
    number: str,
    fields: dict[str, Column | str],
    timestamp: Column | str = "ts",
    partitions: int = TOPIC_PARTITIONS,
) -> DataFrame:
    """Keyed JSON records; key and partition follow from the row's running ``number``."""
    at = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return df.select(
        F.col(number).cast("string").alias("key"),
        (F.col(number) % partitions).cast("int").alias("partition"),
        at.cast("timestamp").alias("timestamp"),
        encode(df, fields).alias("value"),
    )


def wire_fields(schema: StructType) -> dict[str, Column]:
    """The fields of a record layout, from columns of the same names, in the layout's types."""
    return {f.name: F.col(f.name).cast(f.dataType) for f in schema}


def round_robin(partitions: int, start: int = 0) -> Column:
    """A partition number that goes round within each task, like one counter per sink instance.

    Tasks begin one further each, and ``start`` further than that, so that many short tasks, or many
    small batches that pass their number, fill all partitions alike.  No shuffle and no sort: the low
    33 bits of ``monotonically_increasing_id`` count a task's rows.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return ((in_task + F.spark_partition_id() + start) % partitions).cast("int")
