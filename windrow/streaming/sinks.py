"""Sinks: printed rows, files, idempotent batches, twin outputs, lifecycle writers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter

from windrow.operators.publish import round_robin

#: What the jobs take for their results: a stream and its checkpoint to a writer.
Sink = Callable[[DataFrame, str], DataStreamWriter]


def files(df: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Parquet files, exactly once: the sink's log and the checkpoint agree on committed batches."""
    return (
        df.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def to_files(folder: str) -> Sink:
    """:func:`files` of one folder, as a job's sink."""
    return lambda df, checkpoint: files(df, folder, checkpoint)


def batch_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body with repeatable effect: batch ``i`` owns ``batch_id=i`` and a retry
    replaces it whole."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return write


def topic_batch(options: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that writes records to a topic; a retry writes them again, under the
    same keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("kafka").options(**options).save()

    return write


def dealt(
    body: Callable[[DataFrame, int], None], partitions: int
) -> Callable[[DataFrame, int], None]:
    """The body with a ``partition`` column dealt round robin over the tasks of the batch, each batch
    beginning one further."""

    def write(batch: DataFrame, batch_id: int) -> None:
        body(batch.withColumn("partition", round_robin(partitions, batch_id % partitions)), batch_id)

    return write


def batches(
    df: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return (
        df.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).outputMode(mode)
    )


def twin(
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    main: Callable[[DataFrame, int], None],
    side: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that feeds a main and a side output from one read of the batch.

    The batch is kept on the executors between the two writes; a lost executor's part is read again
    from the source, which the checkpoint pins to the same offsets.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            main_rows, side_rows = split(batch)
            main(main_rows, batch_id)
            side(side_rows, batch_id)
        finally:
            batch.unpersist()

    return write


def by_branch(bodies: dict[str, Callable[[DataFrame, int], None]], branch: str = "branch") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that deals the rows of each branch to its own body, from one run of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, body in bodies.items():
                body(batch.where(F.col(branch) == name).drop(branch), batch_id)
        finally:
            batch.unpersist()

    return write


class LifecycleWriter:
    """Row sink with ``open`` / ``process`` / ``close``, to be subclassed.

    Spark opens and closes it once per partition and micro-batch, on the executor.
    """

    label = "result"

    def open(self, partition_id: int, epoch_id: int) -> bool:
        print(f"{self.label}: open partition {partition_id} of batch {epoch_id}")
        return True

    def process(self, row: Row) -> None:
        print(f"{self.label}: {row}")

    def close(self, error: Exception | None) -> None:
        print(f"{self.label}: closed" + (f" on {error}" if error else ""))


def rows_to(df: DataFrame, writer: LifecycleWriter, checkpoint: str) -> DataStreamWriter:
    return df.writeStream.foreach(writer).option("checkpointLocation", checkpoint)


def print_batch(batch: DataFrame, batch_id: int) -> None:
    """A ``foreachBatch`` body that prints every row, as a line of JSON, where it is computed.

    The JVM writes the lines; Python is handed them a batch of Arrow at a time.  None passes through the driver.
    """

    def work(lines: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in lines:
            if some.num_rows:
                print("\n".join(some.column(0).to_pylist()), flush=True)
        return iter(())

    fields = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line")
    batch.select(fields).mapInArrow(work, "line string").write.format("noop").mode("overwrite").save()


def printed(df: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Every result row on the standard output of the executor that holds it; see :func:`print_batch`."""
    return batches(df, print_batch, checkpoint)
