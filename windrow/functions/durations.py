"""Durations given as Spark interval strings ("10 seconds")."""

from __future__ import annotations

import math

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Length of a fixed duration in microseconds: ``micros("1 minute 30 seconds")``."""
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit.lower().removesuffix("s")
        if name not in _MICROS:
            raise ValueError(f"unknown unit {unit!r} in {duration!r}")
        total += int(amount) * _MICROS[name]
    return total


def interval(length: int) -> str:
    """The interval string of a length in microseconds."""
    return f"{length} microseconds"


def common_pane(size: str, slide: str) -> str:
    """Longest span that tiles both the window and its slide."""
    return interval(math.gcd(micros(size), micros(slide)))
