"""Numeric column expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS_PER_DOUBLING = 4096


def half_even(value: Column, digits: int) -> Column:
    """Round a DOUBLE half to even the way array libraries do: scale, round, scale back."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half to even; NULL for an empty whole."""
    return half_even(part / F.nullif(whole, F.lit(0)) * 100, digits)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def coarse_key(value: Column) -> Column:
    """An integer that grows with a finite number: 4,096 steps for every doubling.

    Sorting by it first lets a global order be cut into many independent pieces without
    sampling the data. A step at the edge of a doubling is the same whichever way the
    logarithm rounds.
    """
    size = F.abs(value)
    doublings = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), doublings) - 1) * STEPS_PER_DOUBLING)
    rank = (doublings + 1100) * STEPS_PER_DOUBLING + step
    return F.when(value == 0, F.lit(0).cast("bigint")).when(value > 0, rank).otherwise(-rank)
