"""Tumbling windows whose phase follows each key's first arrival.

Staggering spreads the moment windows fire.  The phase of a key is the time its first row arrived,
modulo the window size, so the edges are a function of the data and can be reproduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from windrow.functions.durations import micros
from windrow.functions.times import epoch_micros, from_epoch_micros
from windrow.operators.heavy import heaviest


def staggered(df: DataFrame, size: str, key: str, ts: str = "ts") -> DataFrame:
    """Add ``window`` (``start``, ``end``), tumbling with a phase per key.

    Phases of the heaviest keys are broadcast (a list of fixed length), so their rows stay where they
    are; only rows of other keys are shuffled, to meet their phase in a join.  Rows without a key
    are one key.
    """
    length = F.lit(micros(size))
    phases = df.groupBy(F.struct(key).alias("_key")).agg(
        F.pmod(epoch_micros(F.min(ts)), length).alias("_phase"),
        F.count(F.lit(1)).alias("_rows"),
    )
    heavy = heaviest(phases, ["_key"], "_rows").select("_key", F.col("_phase").alias("_heavy_phase"))
    marked = df.withColumn("_key", F.struct(key)).join(F.broadcast(heavy), "_key", "left")
    hot = marked.where(F.col("_heavy_phase").isNotNull()).withColumn("_phase", F.col("_heavy_phase"))
    rest = marked.where(F.col("_heavy_phase").isNull()).join(phases.select("_key", "_phase"), "_key")
    phased = hot.select(*df.columns, "_phase").unionByName(rest.select(*df.columns, "_phase"))
    at = epoch_micros(ts)
    start = at - F.pmod(at - F.col("_phase"), length)
    kind = df.schema[ts].dataType
    window = F.struct(
        from_epoch_micros(start, kind).alias("start"),
        from_epoch_micros(start + length, kind).alias("end"),
    )
    return phased.select(*df.columns, window.alias("window"))
