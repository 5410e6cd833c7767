"""Named units summed per name in tumbling windows of their arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame

from windrow.operators.totals import windowed_sums
from windrow.operators.windows import NAME_WINDOWS, Windows


def name_sums(
    units: DataFrame, windows: Windows = NAME_WINDOWS, arrival: str = "arrival_ts"
) -> DataFrame:
    return windowed_sums(units, windows, ["name"], "n", arrival, "n")
