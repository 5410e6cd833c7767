"""A counting quotient filter: a sorted, lossless table of fingerprints and how often each came.

A fingerprint of 64 bits is split into block (its first bits), quotient and remainder.  Of each
block a filter keeps which quotients are occupied, where the run of each ends, and the remainders,
sorted within their run, with a counter each.  Sorted runs of two filters merge in one pass, and
what comes out is the filter of both inputs: nothing is lost, in whatever order filters are merged.
How many quotients a filter has follows from what it holds, so a filter of few fingerprints is small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Fingerprints for one quotient: a filter has between one and two quotients for so many.
RUN = 4


@dataclass(frozen=True)
class Filter:
    """One block's filter, as it is stored and sent.  The remainder takes what block and quotient leave of 64 bits."""

    quotient_bits: int
    occupied: bytes
    run_ends: bytes
    remainders: bytes
    counts: bytes


@dataclass(frozen=True)
class Level:
    """A step of the tree of merges: filters of ``bits`` block bits, of ``fan`` sources each, meet by block."""

    bits: int
    fan: int


def tree(rows: int, sources: int, block_rows: int, fan: int, least_bits: int) -> list[Level]:
    """The steps that merge the filters of ``sources`` tasks over ``rows`` fingerprints.

    Blocks of a step are as many as make ``fan`` sources bring about ``block_rows`` fingerprints to one; the
    last step brings all sources together.  So a filter holds about ``block_rows / fan`` fingerprints
    or more in every step, and a merge about ``block_rows``, however many rows there are.
    """
    steps = max(1, math.ceil(round(math.log(max(1, sources), fan), 9)))
    each = rows / max(1, sources)
    found = [Level(max(0, math.ceil(math.log2(max(1.0, each * fan**k / block_rows)))), fan) for k in range(1, steps)]
    return [*found, Level(max(least_bits, math.ceil(math.log2(max(1.0, rows / block_rows)))), max(1, sources))]


def block_numbers(bits: int, fingerprints: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(fingerprints), np.int32)
    return (fingerprints >> np.uint64(64 - bits)).astype(np.int32)


def _width(bits: int) -> int:
    return -(-bits // 8)


def build(block_bits: int, fingerprints: np.ndarray, counts: np.ndarray) -> Filter:
    """The filter of one block's fingerprints, which are sorted and distinct.  Counters are as wide as the largest needs."""
    bits = max(0, (len(fingerprints) // RUN).bit_length())
    left = 64 - block_bits - bits
    rest = np.uint64(left)
    quotients = (fingerprints >> rest) & np.uint64((1 << bits) - 1) if bits else np.zeros(len(fingerprints), np.uint64)
    remainders = fingerprints & np.uint64((1 << left) - 1)
    occupied = np.zeros(1 << bits, bool)
    occupied[quotients.astype(np.int64)] = True
    ends = np.append(quotients[1:] != quotients[:-1], True) if len(quotients) else np.zeros(0, bool)
    narrow = remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _width(left)]
    wide = _width(int(counts.max()).bit_length()) if len(counts) else 1
    counters = counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
    return Filter(bits, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), narrow.tobytes(), counters.tobytes())


def split(block_bits: int, fingerprints: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, Filter]]:
    """The blocks of sorted, distinct fingerprints, and the filter of each."""
    blocks = block_numbers(block_bits, fingerprints)
    starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
    for start, end in zip(starts, [*starts[1:], len(blocks)], strict=True) if len(blocks) else []:
        yield int(blocks[start]), build(block_bits, fingerprints[start:end], counts[start:end])


def _numbers(stored: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(stored) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(stored, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def read(block_bits: int, block: int, stored: Filter) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter, and their counts."""
    left = 64 - block_bits - stored.quotient_bits
    remainders = _numbers(stored.remainders, _width(left))
    if not len(remainders):
        return remainders, remainders
    counts = _numbers(stored.counts, len(stored.counts) // len(remainders))
    ends = np.unpackbits(np.frombuffer(stored.run_ends, np.uint8), count=len(counts)).astype(bool)
    run = np.cumsum(ends) - ends
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(stored.occupied, np.uint8))).astype(np.uint64)[run]
    high = (np.uint64(block) << np.uint64(stored.quotient_bits)) | quotients
    return (high << np.uint64(left)) | remainders if left < 64 else remainders, counts


def counted(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, with the counts of equal ones added up.

    The stable sort merges sorted runs as they stand.
    """
    if not len(fingerprints):
        return fingerprints, counts
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.append(True, fingerprints[1:] != fingerprints[:-1])
    return fingerprints[first], np.add.reduceat(counts, np.flatnonzero(first))


def merge(block_bits: int, block: int, filters: list[Filter]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints that the given filters of one block have counted, in order, and their counts in all."""
    parts = [read(block_bits, block, each) for each in filters]
    return counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
