"""Running queries to the end of a bounded input."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from windrow.schemas import TOPIC_RECORD

# Later than any event: a row at this time releases every window still open.
END_OF_TIME = datetime(9000, 1, 1)
END_MILLIS = int(END_OF_TIME.replace(tzinfo=timezone.utc).timestamp()) * 1000


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process all there is, then stop.  Windows the watermark has not passed stay in the state."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_end_marker(rows: DataFrame, folder: str, ts: str = "ts") -> None:
    """Close a file source: add one file whose only row lies beyond all windows.

    ``rows`` gives the layout; a time kept as a number is in epoch milliseconds.  A further
    :func:`drain` with the same checkpoint then emits the windows that were still open; the marker's
    own window never closes, so it is never seen.
    """
    spark = rows.sparkSession

    def value(field: StructField) -> Column:
        if field.name != ts:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, NumericType):
            return F.lit(END_MILLIS).cast(field.dataType)
        return F.lit(END_OF_TIME).cast(field.dataType)

    marker = spark.range(1).select(*[value(f).alias(f.name) for f in rows.schema])
    marker.write.mode("append").parquet(folder)


def append_end_record(spark: SparkSession, folder: str, layout: StructType, times: Sequence[str]) -> None:
    """The same for a source of topic records of a ``layout`` whose event time is read from ``times``.

    The marker is a whole, valid record, so that a reader that refuses incomplete ones takes it: its
    other fields are zero or empty.  It stands under a key of its own.
    """
    empty = {f.name: F.lit("") if isinstance(f.dataType, StringType) else F.lit(0).cast(f.dataType) for f in layout}
    fields = empty | {name: F.lit(END_MILLIS) for name in times}
    columns = {
        "key": F.lit("end"),
        "partition": F.lit(0),
        "timestamp": F.lit(END_OF_TIME).cast("timestamp"),
        "value": F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).cast("binary"),
    }
    marker = spark.range(1).select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in TOPIC_RECORD])
    marker.write.mode("append").parquet(folder)
