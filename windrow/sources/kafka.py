"""Topics: option maps for Spark's Kafka source and sink.

All record logic lives in ``windrow.sources.records`` and ``windrow.operators.publish``; this
module only names options.  The connector package must be on the session's classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def reader_options(
    servers: str,
    topic: str,
    group: str | None = None,
    group_prefix: str | None = None,
    client_id: str | None = None,
) -> dict[str, str]:
    """Read a topic from its earliest offset.  Restarts go on from the checkpoint; the group only
    names the consumer."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group:
        options["kafka.group.id"] = group
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if client_id:
        options["kafka.client.id"] = client_id
    return options


def writer_options(
    servers: str,
    topic: str,
    batch_bytes: int | None = None,
    linger_ms: int | None = None,
    retries: int | None = None,
    acks: str | None = None,
    client_id: str | None = None,
) -> dict[str, str]:
    """Write to a topic; producer settings pass through.  Keys and values go out as bytes."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    producer = {
        "kafka.batch.size": batch_bytes,
        "kafka.linger.ms": linger_ms,
        "kafka.retries": retries,
        "kafka.acks": acks,
        "kafka.client.id": client_id,
    }
    options.update({k: str(v) for k, v in producer.items() if v is not None})
    return options


# Producer tuning of the two publishers.
TRANSACTION_PRODUCER = {"batch_bytes": 100, "linger_ms": 50, "retries": 2, "acks": "1"}
TOTALS_PRODUCER = {"batch_bytes": 100, "linger_ms": 1000, "retries": 3, "acks": "1"}


# How the lateness operators find a topic's order: each partition is a source of its own.
TOPIC_ORDER = {"source": "partition", "arrival": "offset", "tiebreak": "offset"}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(records: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """At least once; readers drop repeats by ``key`` (see ``encode_by_store``)."""
    return (
        records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    )
