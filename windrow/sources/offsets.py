"""A stream source with offsets of its own: records in files of several partitions, as a topic has them.

A folder holds ``partition=<n>`` folders of parquet files that are only ever added to, by one job at a time.  The
files of a partition, by date and then by name, are one sequence of records, and an offset is a record's place in
it: names alone would not do, since those of a later job may come first.  A query starts
at the first record (or where it is told), goes on from the offsets of its checkpoint, and ends, if it is
bounded, at stated offsets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "windrow-records"
#: Records of an Arrow batch, and records that one task reads, a file's end permitting.
BATCH, TASK = 10_000, 1_000_000


@dataclass
class Slice(InputPartition):
    """Records ``first`` to ``past - 1`` of a file."""

    path: str
    first: int
    past: int

    def __init__(self, path: str, first: int, past: int):
        super().__init__((path, first, past))
        self.path, self.first, self.past = path, first, past


class RecordReader(DataSourceStreamReader):
    """Offsets are ``{partition: records before it}``."""

    def __init__(self, path: str, columns: list[str], start: dict[str, int], end: dict[str, int] | None):
        self.path, self.columns, self.start, self.end = path, columns, start, end
        self.sizes: dict[str, int] = {}
        self.done: dict[str, int] = {}

    def _files(self) -> dict[str, list[tuple[str, int]]]:
        """Each partition's files with their numbers of records; footers are read once."""
        system, root = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        found: dict[str, list[tuple[str, int]]] = {}
        for folder in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name, _, number = folder.base_name.partition("=")
            if name != "partition":
                continue
            held = (f for f in system.get_file_info(fs.FileSelector(folder.path)) if f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))
            files = [f.path for f in sorted(held, key=lambda f: (f.mtime_ns or 0, f.base_name))]
            for file in files:
                if file not in self.sizes:
                    self.sizes[file] = pq.read_metadata(file, filesystem=system).num_rows
            found[number] = [(f, self.sizes[f]) for f in files]
        return found

    def initialOffset(self) -> dict:
        return dict(self.start)

    def latestOffset(self) -> dict:
        ends = {number: sum(n for _, n in files) for number, files in self._files().items()}
        if self.end is not None:
            ends = {number: min(n, self.end.get(number, 0)) for number, n in ends.items()}
        return {number: max(n, self.start.get(number, 0)) for number, n in ends.items()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        slices = []
        for number, files in sorted(self._files().items()):
            low, high, before = start.get(number, 0), end.get(number, 0), 0
            for file, n in files:
                first, past = max(low - before, 0), min(high - before, n)
                slices += [Slice(file, at, min(at + TASK, past)) for at in range(first, past, TASK)]
                before += n
        return slices

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")[0]
        at = 0
        with pq.ParquetFile(partition.path, filesystem=system) as file:
            for batch in file.iter_batches(BATCH, columns=self.columns):
                low, high = max(partition.first - at, 0), min(partition.past - at, batch.num_rows)
                if low < high:
                    yield batch.slice(low, high - low)
                at += batch.num_rows
                if at >= partition.past:
                    return

    def commit(self, end: dict) -> None:
        self.done = dict(end)

    def stop(self) -> None:
        self.sizes.clear()


class RecordFiles(DataSource):
    """``readStream.format("windrow-records")`` with ``path`` and, as JSON, ``start`` and ``end`` offsets."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        start, end = (json.loads(self.options[o]) if o in self.options else None for o in ("start", "end"))
        return RecordReader(self.options["path"], schema.fieldNames(), start or {}, end)


def record_stream(spark: SparkSession, folder: str, schema: StructType, start: dict[str, int] | None = None, end: dict[str, int] | None = None) -> DataFrame:
    """The records of ``folder`` as a stream, from the earliest offset of each partition unless told otherwise,
    and up to ``end`` if given: then later records are never read.

    A batch takes all there is.  Files are read on the executors in Arrow batches, each task up to a million records
    of one file; the driver reads names and footers.
    """
    spark.dataSource.register(RecordFiles)
    reader = spark.readStream.format(FORMAT).schema(schema).option("path", folder)
    for name, offsets in (("start", start), ("end", end)):
        if offsets is not None:
            reader = reader.option(name, json.dumps(offsets))
    return reader.load()
