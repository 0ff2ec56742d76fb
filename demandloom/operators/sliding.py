"""Sliding windows whose cost per row does not grow with their length.

A frame of ``w`` rows is evaluated row by row over all ``w`` values. Here the positions of a series are cut
into cells of ``w`` rows. Inside a cell the statistics of all rows from its start (prefix) and of all rows to
its end (suffix) are growing frames, one step per row. A window that ends inside a cell is the prefix there
merged with the suffix that starts ``w - 1`` rows earlier, in the cell before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Shorter windows are plain frames: two sorts cost more than so many steps per row.
CELLS_FROM = 32


def _merged(a: Column, b: Column) -> Column:
    """The statistics of two disjoint sets of values; either may be empty."""
    n = a["n"] + b["n"]
    apart = F.try_divide(a["sum"], a["n"]) - F.try_divide(b["sum"], b["n"])
    between = F.coalesce(apart * apart * a["n"] * F.try_divide(b["n"], n), F.lit(0.0))
    return F.struct(n.alias("n"), (a["sum"] + b["sum"]).alias("sum"),
                    (a["m2"] + b["m2"] + between).alias("m2"),
                    F.least(a["min"], b["min"]).alias("min"), F.greatest(a["max"], b["max"]).alias("max"))


def _statistics(value: Column, frame: WindowSpec) -> Column:
    n = F.count(value).over(frame)
    return F.struct(n.alias("n"), F.coalesce(F.sum(value).over(frame), F.lit(0.0)).alias("sum"),
                    F.coalesce(F.var_pop(value).over(frame) * n, F.lit(0.0)).alias("m2"),
                    F.min(value).over(frame).alias("min"), F.max(value).over(frame).alias("max"))


def sliding_statistics(df: DataFrame, partition: Sequence[str], ordinal: str, value: Column,
                       sizes: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Add, for every size, ``n, sum, m2, min, max`` of the last ``size`` rows as a struct.

    ``partition`` holds series, or stretches of them, that are one task's work each; ``ordinal`` counts the
    rows of a series from 1. Missing values don't count. All sizes share one move of the rows, by
    ``partition``; each adds two sorts of what a task holds.
    """
    position = F.col(ordinal) - 1
    series = W.partitionBy(*partition).orderBy(ordinal)
    df = df.repartition(*[F.col(c) for c in partition]).withColumn("_value", value)
    for size in sizes:
        df = df.withColumn("_cell", F.floor(position / F.lit(size)))
        cell = W.partitionBy(*partition, "_cell")
        grown = W.unboundedPreceding, W.currentRow
        up, down = cell.orderBy(ordinal), cell.orderBy(F.col(ordinal).desc())
        df = (df.withColumn(f"_prefix{size}", _statistics(F.col("_value"), up.rowsBetween(*grown)))
              .withColumn(f"_suffix{size}", _statistics(F.col("_value"), down.rowsBetween(*grown))))
    for size in sizes:
        df = df.withColumn(f"_suffix{size}", F.lag(f"_suffix{size}", size - 1).over(series))
    for size, name in zip(sizes, names, strict=True):
        prefix, suffix = F.col(f"_prefix{size}"), F.col(f"_suffix{size}")
        whole = suffix.isNull() | (position % size == size - 1)
        df = df.withColumn(name, F.when(whole, prefix).otherwise(_merged(prefix, suffix)))
    return df.drop("_value", "_cell", *[f"_{p}{s}" for s in sizes for p in ("prefix", "suffix")])
