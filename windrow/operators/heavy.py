"""The few groups that hold many rows.

A list of the heaviest groups has a fixed length whatever the data, so it may be broadcast; every
group that is not on it holds less than ``1 / limit`` of all rows or no more than ``above`` rows,
so it may go to one task.  The list bears on where rows are joined, never on results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LIMIT = 10_000
# Rows of one group that one task may well take.
ABOVE = 4_000_000


def heaviest(
    counted: DataFrame, keys: Sequence[str], rows: str, above: int = ABOVE, limit: int = LIMIT
) -> DataFrame:
    """The ``limit`` groups of ``counted`` with the most ``rows``, of those with more than ``above``."""
    big = counted.where(F.col(rows) > above)
    return big.orderBy(F.desc(rows), *keys).limit(limit)
