"""Time windows: half-open ``[start, start + size)``, aligned to the epoch in UTC plus an offset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from windrow.functions.durations import common_pane, interval, micros
from windrow.functions.times import shift


@dataclass(frozen=True)
class Windows:
    """Sliding windows, or tumbling ones where ``slide`` is left out."""

    size: str
    slide: str | None = None
    offset: str = "0 seconds"

    @property
    def step(self) -> str:
        return self.slide or self.size

    @property
    def overlapping(self) -> bool:
        return micros(self.step) < micros(self.size)

    @property
    def pane(self) -> Windows:
        """The tumbling windows that tile every window of this kind."""
        pane = common_pane(self.size, self.step)
        return Windows(pane, None, interval(micros(self.offset) % micros(pane)))

    def of(self, ts: Column | str) -> Column:
        """The window struct (``start``, ``end``); a row falls into every window that covers it."""
        return F.window(ts, self.size, self.step, self.offset)


# The window and delay settings of the streams as they run in production.
RETAIL_WINDOWS = Windows("10 seconds", "5 seconds", "2 seconds")
ROLLUP_WINDOWS = Windows("5 seconds")
WORD_WINDOWS = Windows("5 seconds", None, "2 seconds")
NAME_WINDOWS = Windows("3 seconds")
READING_WINDOWS = Windows("1 second")
RETAIL_DELAY = "2 seconds"
NO_DELAY = "0 seconds"


def placed(df: DataFrame, windows: Windows, ts: str) -> Column:
    """The window of ``ts`` as a grouping column: the struct on a stream, whose watermark goes with
    it, and the bare start in batch, a fifth of the struct's size in every shuffled row."""
    if df.isStreaming:
        return windows.of(ts).alias("window")
    return windows.of(ts)["start"].alias("window_start")


def with_bounds(df: DataFrame, windows: Windows | None = None) -> DataFrame:
    """Put ``window_start`` and ``window_end`` first, in place of a window struct or, given
    ``windows``, of a bare window start."""
    if "window" in df.columns:
        start, end = F.col("window.start"), F.col("window.end")
    else:
        start = F.col("window_start")
        end = shift(start, windows.size)
    rest = [F.col(c) for c in df.columns if c not in ("window", "window_start")]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)
