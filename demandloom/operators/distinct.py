"""Distinct counts that can be kept per week and merged for any range of weeks.

A sketch has a fixed size whatever it has seen, so a count over years needs neither the rows nor a shuffle
of their values: sketches are made on the map side, stored with the weekly tables and merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 ** 14 registers: a standard error of about 0.8 %.
REGISTERS_LOG = 14


def distinct_sketches(df: DataFrame, columns, groupby=("year", "week"),
                      registers_log: int = REGISTERS_LOG) -> DataFrame:
    """One sketch per group and column, under the column's name; missing values are not counted."""
    return df.groupBy(*groupby).agg(*[
        F.hll_sketch_agg(F.col(c), registers_log).alias(c) for c in columns])


def estimated_distinct(sketches: DataFrame, columns, groupby=(), where: Column | None = None) -> DataFrame:
    """Estimated distinct values per column over the merged sketches of ``where``, 0 if there are none."""
    picked = sketches if where is None else sketches.filter(where)
    return picked.groupBy(*groupby).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(c), True)), F.lit(0)).alias(c) for c in columns])
