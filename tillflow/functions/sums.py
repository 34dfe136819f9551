"""Sums of doubles that don't depend on the order or the partitioning of the rows.

A value is cut into whole numbers on a fixed grid: its whole part and three parts of its
fraction of 20 bits each, all with its sign. Whole numbers add up exactly in any order, and the double
made of the four sums is a function of these alone. Bits below 2**-60 are cut off, so a
value of 2**-7 or more counts exactly. Values that are not finite or reach ``LIMIT`` are
added as doubles beside (NaN stays NaN). A sum that leaves the range of a long
(2**27 rows of nearly ``LIMIT``) raises in Spark, as any sum of longs does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, functions as F

LIMIT = float(1 << 36)
PARTS = 4
_BITS = 20
_STEP = float(1 << _BITS)
_MASK = (1 << _BITS) - 1
_ONE = 1 << 3 * _BITS  # 1 in units of the last part


def parts(x: Column) -> tuple[list[Column], Column]:
    """The parts of a double (null outside the grid's range), and the value that is added beside (null inside)."""
    inside = F.abs(x) < LIMIT
    value = F.when(inside, F.abs(x))
    out = [F.floor(value)]
    left = value - out[0]
    for _ in range(PARTS - 1):
        left = left * _STEP
        out.append(F.floor(left))
        left = left - out[-1]
    return [F.when(x < 0, -p).otherwise(p) for p in out], F.when(~inside, x)


def joined(sums: Sequence[Column]) -> Column:
    """The double nearest to summed parts (null if one is)."""
    up = lambda low, high: [high + F.shiftright(low[0], _BITS), low[0].bitwiseAND(F.lit(_MASK)), *low[1:]]
    whole, *fraction = reduce(up, sums[-2::-1], [sums[-1]])
    units = reduce(lambda a, b: F.shiftleft(a, _BITS) + b, fraction)
    # a negative sum is put together from its amount, so that small ones keep their digits
    minus = whole < 0
    amount = F.when(minus, -whole - 1).otherwise(whole).cast("double") + F.when(minus, F.lit(_ONE) - units).otherwise(units).cast("double") / float(_ONE)
    return F.when(minus, -amount).otherwise(amount)


def exact_sum(x: Column) -> Column:
    """Aggregate: the sum of a double (or float) column; null if all values are. Partial sums merge as those of longs do."""
    cut, beside = parts(x.cast("double"))
    total, rest = joined([F.sum(p) for p in cut]), F.sum(beside)
    return F.coalesce(total + rest, total, rest)


def parts_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``parts`` of an array: a row of whole numbers for each part, and what is added beside (0 inside the grid)."""
    inside = np.abs(values) < LIMIT
    left = np.where(inside, values, 0.0)
    out = np.empty((PARTS, len(values)), np.int64)
    for j in range(PARTS):
        left = left * _STEP if j else left
        whole = np.trunc(left)
        out[j] = whole
        left = left - whole
    return out, np.where(inside, 0.0, values)


def joined_of(sums: np.ndarray) -> np.ndarray:
    """``joined`` for arrays of summed parts, one row each."""
    sums = sums.copy()
    for j in range(PARTS - 1, 0, -1):
        sums[j - 1] += sums[j] >> _BITS
        sums[j] &= _MASK
    whole, units = sums[0], sums[1]
    for part in sums[2:]:
        units = (units << _BITS) + part
    minus = whole < 0
    amount = np.where(minus, -whole - 1, whole).astype(np.float64) + np.where(minus, _ONE - units, units).astype(np.float64) / _ONE
    return np.where(minus, -amount, amount)
