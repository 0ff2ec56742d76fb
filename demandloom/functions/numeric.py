"""Arithmetic that treats NaN and infinities as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """NaN and both infinities become null."""
    unbounded = F.abs(value) == F.lit(float("inf"))
    return F.when(~(F.isnan(value) | unbounded), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division where a zero denominator, or any non-finite outcome, is missing."""
    return finite(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def nonnegative_units(prediction: Column) -> Column:
    """Round half to even, clip at zero, as a whole number."""
    return F.greatest(F.rint(prediction), F.lit(0.0)).cast("long")
