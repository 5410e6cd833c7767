"""JSON records in a topic's ``value BINARY`` column: decode and encode.

Pure DataFrame transforms: the same code runs on a topic, on a table of topic records, on a batch
and on a stream.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from windrow.functions.times import epoch_millis
from windrow.schemas import BY_PRODUCT, BY_STORE, TRANSACTION


def decode(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The record's fields as columns.  A malformed record, or one that lacks a field, has a null in
    it or a value of another kind, fails the job, whichever columns are used later on."""
    record = F.from_json(_text(), _wire(schema), {"mode": "FAILFAST", **_STRICT})
    refused = F.raise_error(F.lit("record with a missing, null or mistyped field")).cast(schema)
    checked = F.transform(
        F.array(record), lambda r: F.when(_complete(r, schema), _typed(r, schema)).otherwise(refused)
    )
    return df.select(*keep, F.inline(checked))


def decode_or_quarantine(
    df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: decoded rows, and the untouched input rows that do not decode."""
    complete, good = _tried(schema)
    return df.select(*keep, F.inline(good)), df.where(F.size(complete) == 0)


def _tried(schema: StructType) -> tuple[Column, Column]:
    """Arrays of the record if it is complete, else empty: as it was read, and in the types of the layout."""
    record = F.array(F.from_json(_text(), _wire(schema), {"mode": "PERMISSIVE", **_STRICT}))
    complete = F.filter(record, lambda r: _complete(r, schema))
    return complete, F.transform(complete, lambda r: _typed(r, schema))


def parsed(df: DataFrame, schema: StructType) -> DataFrame:
    """The input rows with ``_good``: an array of the decoded record, empty if it does not decode.  To be kept, so that
    both halves of :func:`split_parsed` read it."""
    return df.withColumn("_good", _tried(schema)[1])


def split_parsed(tried: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of :func:`parsed` rows."""
    return tried.select(*keep, F.inline("_good")), tried.where(F.size("_good") == 0).drop("_good")


def decode_transactions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return decode(df, TRANSACTION, keep)


def decode_by_store(df: DataFrame, amount: str = "double") -> DataFrame:
    """Per-store totals as written by :func:`encode_by_store`.  ``amount`` is the type to read their
    sums in: a DECIMAL gives back to the last digit what was written as one."""
    return _totals(decode(df, _summed(BY_STORE, amount)), "storeId", "store_id")


def decode_by_product(df: DataFrame, amount: str = "double") -> DataFrame:
    return _totals(decode(df, _summed(BY_PRODUCT, amount)), "productId", "product_id")


def _summed(schema: StructType, amount: str) -> StructType:
    """The layout with another type of sum."""
    kind = StructType.fromDDL(f"sumAmount {amount}")["sumAmount"].dataType
    return StructType([StructField(f.name, kind if f.name == "sumAmount" else f.dataType) for f in schema])


def encode(df: DataFrame, fields: dict[str, Column | str] | None = None) -> Column:
    """JSON bytes of a row: all columns, or ``fields`` (name -> column)."""
    if fields is None:
        fields = {c: c for c in df.columns}
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]
    return F.to_json(F.struct(*named)).cast("binary")


def encode_by_store(totals: DataFrame) -> DataFrame:
    """Topic records of per-store totals.  The key names the (store, window) pair: a batch that is
    written twice can be told from two results."""
    return _totals_record(totals, "storeId", "store_id")


def encode_by_product(totals: DataFrame) -> DataFrame:
    return _totals_record(totals, "productId", "product_id")


def _text() -> Column:
    return F.col("value").cast("string")


# NaN and infinities are no JSON numbers.
_STRICT = {"allowNonNumericNumbers": "false"}


def _wire(schema: StructType) -> StructType:
    """The layout to parse with: text fields as they stand, since a parser would turn any other value
    into text."""
    return StructType([StructField(f.name, VariantType() if f.dataType == StringType() else f.dataType) for f in schema])


def _complete(record: Column, schema: StructType) -> Column:
    """Whether no field is null, and text fields hold text.  Used inside a lambda, where the record is
    parsed once: as a plain filter Catalyst would write the parse out again for every field."""
    checks = [
        F.schema_of_variant(record.getField(f.name)) == "STRING" if f.dataType == StringType() else record.getField(f.name).isNotNull()
        for f in schema
    ]
    return reduce(and_, [F.coalesce(check, F.lit(False)) for check in checks])


def _typed(record: Column, schema: StructType) -> Column:
    return F.struct(*[record.getField(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _totals(decoded: DataFrame, wire_key: str, key: str) -> DataFrame:
    return decoded.select(
        F.timestamp_millis("windowStart").alias("window_start"),
        F.timestamp_millis("windowEnd").alias("window_end"),
        F.col(wire_key).alias(key),
        F.col("sumAmount").alias("sum_amount"),
        F.col("tranCount").alias("tran_count"),
    )


def _totals_record(totals: DataFrame, wire_key: str, key: str) -> DataFrame:
    start = epoch_millis("window_start")
    value = encode(
        totals,
        {
            wire_key: F.col(key).cast("bigint"),
            "sumAmount": "sum_amount",
            "tranCount": "tran_count",
            "windowStart": start,
            "windowEnd": epoch_millis("window_end"),
        },
    )
    return totals.select(F.concat_ws("@", key, start).alias("key"), value.alias("value"))
