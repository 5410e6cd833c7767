"""The given tables seen as the inputs of the streams.

Only the columns a view names are read; times stay TIMESTAMP_NTZ for batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from windrow.functions.times import date_text, epoch_millis, time_text


#: The tables keep amounts as DOUBLE; all have two decimals.
MONEY = "decimal(18,2)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(events: DataFrame) -> DataFrame:
    """Events as retail transactions; ``ts`` is kept beside the record.  Ids are as wide as the
    table's: the wire layout narrows them when they are published."""
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("user_id") % 20 + 1).cast("int").alias("store_id"),
        F.col("value").cast("float").alias("price"),
        (F.col("event_id") % 50 + 1).cast("int").alias("product_id"),
        date_text("ts").alias("date"),
        time_text("ts").alias("time"),
        epoch_millis("ts").alias("timestamp"),
        "ts",
    )


def sales(lineitem: DataFrame) -> DataFrame:
    """Line items as transactions: supplier as store, part as product, ship date as event time."""
    return lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_shipdate").alias("ts"),
    )


def net_sales(lineitem: DataFrame) -> DataFrame:
    """Line items as transactions at what is paid for them, to the last digit: six decimals."""
    price, discount, tax = (F.col(f"l_{c}").cast(MONEY) for c in ("extendedprice", "discount", "tax"))
    one = F.lit(1).cast(MONEY)
    return lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        (price * (one - discount)).cast("decimal(18,4)").alias("_net"),
        (one + tax).cast("decimal(4,2)").alias("_gross"),
        F.col("l_shipdate").alias("ts"),
    ).select("store_id", (F.col("_net") * F.col("_gross")).cast("decimal(18,6)").alias("price"), "ts")


def named_units(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("name"), F.lit(1).alias("n"), F.col("ts").alias("arrival_ts")
    )


def readings(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("sensor"), F.col("user_id") % 10).alias("sensor_id"),
        F.col("value").alias("temperature"),
        "ts",
        F.col("event_id").alias("reading_id"),
    )


def texts(documents: DataFrame) -> DataFrame:
    """Texts with an event time: one second per document."""
    ts = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(
        secs=F.col("doc_id").cast("decimal(18,6)")
    )
    return documents.select("doc_id", "text", ts.alias("ts"))


def shuffled_arrivals(events: DataFrame) -> DataFrame:
    """Events of three source partitions, every seventh of which comes 40 places late."""
    delay = F.when(F.col("event_id") % 7 == 0, 40).otherwise(0)
    return events.select(
        F.col("event_id").alias("row_id"),
        "ts",
        (F.col("user_id") % 20 + 1).cast("int").alias("store_id"),
        F.col("value").alias("price"),
        (F.col("event_id") % 3).alias("source_partition"),
        (F.col("event_id") + delay).alias("arrival"),
    )
