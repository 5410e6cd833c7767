"""Record layouts.  Readers always get one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the JSON records exchanged through topics.
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("price", T.FloatType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("date", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# Totals travel with their window bounds (epoch milliseconds), so that a reader can roll them up
# by event time.  Ids, sums and counts are wider than the classic INT / FLOAT pair: no silent wrap.
BY_STORE = T.StructType(
    [
        T.StructField("storeId", T.LongType()),
        T.StructField("sumAmount", T.DoubleType()),
        T.StructField("tranCount", T.LongType()),
        T.StructField("windowStart", T.LongType()),
        T.StructField("windowEnd", T.LongType()),
    ]
)

BY_PRODUCT = T.StructType(
    [T.StructField("productId", T.LongType()), *BY_STORE.fields[1:]]
)

READING = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("sensorId", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)

TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
    ]
)
