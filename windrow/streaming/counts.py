"""Good and refused records of a running job: two outputs from one parse, and their numbers as they go by."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from windrow.sources.records import parsed, split_parsed
from windrow.streaming import sinks

#: The name under which a job's progress tells its numbers.
METRICS = "records"


def decoded(
    records: DataFrame,
    schema: StructType,
    good: Callable[[DataFrame, int], None],
    bad: Callable[[DataFrame, int], None],
    checkpoint: str,
    keep: tuple[str, ...] = (),
) -> DataStreamWriter:
    """Decoded rows to ``good``, and the untouched records that do not decode to ``bad``.

    A batch is parsed once for both.  The query's progress has the numbers ``n`` and ``refused`` of each batch as
    observed metrics, which :class:`RecordCounts` adds up.
    """
    tried = parsed(records, schema)
    seen = tried.observe(METRICS, F.count(F.lit(1)).alias("n"), F.count_if(F.size("_good") == 0).alias("refused"))
    body = sinks.twin(lambda batch: split_parsed(batch, keep), good, bad)
    return sinks.batches(seen, body, checkpoint)


class RecordCounts(StreamingQueryListener):
    """Adds up the numbers of all queries of a session: ``spark.streams.addListener(counts)``.

    A batch counts once, however often its progress is told.
    """

    def __init__(self) -> None:
        self.by_batch: dict[tuple[str, int], Counter] = {}

    @property
    def total(self) -> Counter:
        return sum(self.by_batch.values(), Counter())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is not None:
            self.by_batch[str(event.progress.id), event.progress.batchId] = Counter(row.asDict())

    def onQueryTerminated(self, event) -> None:
        pass
