"""A sink in two phases: tasks stage files, the end of a batch commits all of them at once.

A commit is one small file that names the batch's data files; readers go by commits, so files of a batch
that failed before its commit, or of an attempt that was repeated, are never seen.  A batch that comes
again after its commit, because the query stopped before it could note that, is thrown away.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

FORMAT = "windrow-transactional"


@dataclass
class Staged(WriterCommitMessage):
    """A task's data file, or none if it had no rows."""

    name: str | None


class Folder:
    """``data`` and ``commits`` under a path that driver and executors share."""

    def __init__(self, path: str):
        self.system, self.path = fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else fs.FileSystem.from_uri(f"file://{path}")

    def data(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def commit(self, batch_id: int) -> str:
        return f"{self.path}/commits/{batch_id:020d}.json"

    def exists(self, path: str) -> bool:
        return self.system.get_file_info(path).type != fs.FileType.NotFound

    def remove(self, messages: list[WriterCommitMessage | None]) -> None:
        for message in messages:
            if message is not None and message.name is not None and self.exists(self.data(message.name)):
                self.system.delete_file(self.data(message.name))

    def committed(self) -> list[str]:
        """The data files of all commits, in the order of their batches."""
        found = self.system.get_file_info(fs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        names = []
        for file in sorted((f.path for f in found if f.path.endswith(".json"))):
            with self.system.open_input_stream(file) as source:
                names += json.loads(source.read())
        return names

    def staged(self) -> list[str]:
        """All data files, whether committed or left behind."""
        return [f.base_name for f in self.system.get_file_info(fs.FileSelector(f"{self.path}/data", allow_not_found=True))]


class TransactionalWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """One file of the task's rows, under a name that no other attempt has."""
        folder, name, writer = Folder(self.path), f"{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    folder.system.create_dir(f"{folder.path}/data", recursive=True)
                    writer = pq.ParquetWriter(folder.data(name), batch.schema, filesystem=folder.system)
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
        return Staged(None if writer is None else name)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        folder = Folder(self.path)
        final = folder.commit(batchId)
        if folder.exists(final):
            folder.remove(messages)
            return
        folder.system.create_dir(f"{folder.path}/commits", recursive=True)
        names = sorted(m.name for m in messages if m is not None and m.name is not None)
        draft = f"{final}.{uuid.uuid4().hex}"
        with folder.system.open_output_stream(draft) as out:
            out.write(json.dumps(names).encode())
        folder.system.move(draft, final)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        Folder(self.path).remove(messages)


class TransactionalFiles(DataSource):
    """``writeStream.format("windrow-transactional")`` with the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return TransactionalWriter(self.options["path"])


def transactional(df: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Each row of the stream once, whatever fails on the way, for readers of :func:`committed`."""
    df.sparkSession.dataSource.register(TransactionalFiles)
    return df.writeStream.format(FORMAT).option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")


def to_transactions(folder: str):
    """:func:`transactional` of one folder, as a job's sink."""
    return lambda df, checkpoint: transactional(df, folder, checkpoint)


def committed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches.  The driver reads the names of files, and no rows."""
    at = Folder(folder)
    names = at.committed()
    base = folder.rstrip("/")
    return spark.read.schema(schema).parquet(*[f"{base}/data/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def sweep(folder: str) -> int:
    """Remove the data files that no commit names, once no query writes; returns how many."""
    at = Folder(folder)
    left = set(at.staged()) - set(at.committed())
    at.remove([Staged(name) for name in left])
    return len(left)
