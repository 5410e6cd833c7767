"""What several operators need: cut lineage, size checks, words, rows kept by a decision."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

#: Files of a narrow checkpoint for each core.
FILES_PER_CORE = 4
#: Rows of an Arrow batch.
BATCH_ROWS = 1000
#: Rows of a narrow table that may be broadcast: at 16 bytes each, 16 MB.
BROADCAST_ROWS = 1_000_000


def checkpointed(df: DataFrame, narrow: bool = False) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` and read from there.

    A lost executor costs no more than a reread.  Where the session names no folder, as in tests,
    checkpoints go beside its warehouse.  ``narrow`` results of a shuffle are written as a few files
    for each core at most: their tasks read one shuffle partition after the other.
    """
    _shared_folder(df.sparkSession)
    files = FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return (df.coalesce(files) if narrow else df).checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the same folder: for whole documents, of which a reader wants some columns."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A name of its own for a table in the same folder; who writes it may remove it (:func:`windrow.session.remove_folder`)."""
    return f"{_shared_folder(spark)}/table-{uuid.uuid4().hex}"


def _shared_folder(spark: SparkSession) -> str:
    """This application's own folder within that of ``spark.checkpoint.dir``; a local session may name none."""
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("a cluster's session must name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints")
    return spark.sparkContext.getCheckpointDir()


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``rows`` rows, else as it is.

    ``df`` should be narrow and already written, since the count reads it.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ascii_lower(data: bytes | None) -> bytes:
    """Only A-Z change; null is empty."""
    return b"" if data is None else data.lower()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def mapped(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with empty batches passed over.

    The rows hold whole texts, so batches are kept to ``BATCH_ROWS`` rows in this session: that, and
    the longest texts, set what a task holds at a time on either side of Python.
    """
    conf, setting = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(setting)) <= BATCH_ROWS:
        conf.set(setting, BATCH_ROWS)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()  # what an earlier task of this worker has left: functions sent by value, and their tables
        pa.default_memory_pool().release_unused()
        return work(batch for batch in batches if batch.num_rows)

    return df.mapInArrow(full, schema)


def first_rows(df: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group, with their ``rank`` (from 1).

    First among the rows of a 64th of the tasks, then among what those leave: Spark cuts each task's
    rows before they are shuffled, so no task sorts more of a group than its share of the tasks leaves.
    """
    (share,) = fresh(df, "share")
    near = Window.partitionBy(*group, share).orderBy(*order)
    some = df.withColumn(share, F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= most)
    return some.drop(share, "rank").withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= most)


def text_tag(text: str = "text") -> Column:
    """A short name of a row's own text, to tell rows of one id apart; null and empty are one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores put before those that ``df`` has already."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def without_rows(docs: DataFrame, dropped: DataFrame, repeated: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a decision keeps, with all their columns.

    ``dropped`` and ``repeated`` hold (key, tag) pairs, tag from :func:`text_tag`: pairs to leave
    out, and pairs of which several rows exist and one is to stay.  Both are broadcast only if they
    are counted to be small; else the rows meet in a shuffle join, which Spark splits where skewed.
    """
    tag, drop_key, drop_tag = fresh(docs, "tag", "drop_key", "drop_tag")
    tagged = docs.withColumn(tag, text_tag(text))

    def at(pairs: DataFrame) -> tuple[DataFrame, Column]:
        pairs = sized(pairs.select(F.col(key).alias(drop_key), F.col("tag").alias(drop_tag)))
        return pairs, tagged[key].eqNullSafe(F.col(drop_key)) & (tagged[tag] == F.col(drop_tag))

    kept = tagged.join(*at(dropped), "left_anti")
    if repeated.isEmpty():
        return kept.drop(tag)
    single = kept.join(*at(repeated), "left_anti")
    several = kept.join(*at(repeated), "left_semi")
    return single.unionByName(several.dropDuplicates([key, tag])).select(*docs.columns)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
