"""Session settings the transforms rely on."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# What a cluster session should set before it starts streams: state beyond the heap, written as
# changes only.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tolerate_idle_sources(spark: SparkSession) -> SparkSession:
    """Over a union of streams, let the source that is ahead move the watermark, so that a silent one
    does not hold windows open.  (Within one source an idle partition never does.)"""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    return spark


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """:data:`STREAM_SETTINGS` for the streams started within, and what was set before after it."""
    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    for k, v in STREAM_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make window edges, epoch conversions and formatted times independent of the host zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", name: str = "windrow", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` or, in a local session that names none, the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("a cluster's session must name a folder that all executors share in spark.checkpoint.dir")
    return (named or spark.conf.get("spark.sql.warehouse.dir", "")).rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that a run has made for itself, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, by name; nothing if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []


def date_in_order(spark: SparkSession, folder: str) -> None:
    """Date the files of a finished job one second apart, in the order of their names.

    A file stream reads by date, and tasks end in any order.  The dates lie in the past; the driver sees
    names only.  The file system must keep dates that are set, as local ones and HDFS do.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in system.listStatus(path) if not f.getPath().getName().startswith(("_", "."))), key=lambda f: f.getName())
    first = (int(time.time()) - len(files)) * 1000
    for i, file in enumerate(files):
        system.setTimes(file, first + 1000 * i, -1)
