"""Sums of currency amounts, as exact as their type.

A ``DECIMAL`` is summed at its own scale in 38 digits: exact, the same whatever the order of the
rows, and an error rather than a wrap where even these do not do.  ``FLOAT`` and ``DOUBLE`` are
summed as ``DOUBLE``, unrounded; who wants exact sums of such a column says what its amounts are, by
a cast to ``DECIMAL``.  Between stages a sum keeps its type; results show it as ``DOUBLE``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def total(amount: Column | str) -> Column:
    return F.sum(amount)


def shown(amount: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount.cast("double")
