"""Row numbers without sorting everything in one task, and the sizes of time-ordered folds.

Rows are laid out in ranges of keys, order and a row id of their own, so neither a key with a third of all
rows nor a long run of ties ends up in one task. The position of a row is its place inside its range plus
the rows of its key in earlier ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from ..spec import WEEKLY, SeriesSpec

ORDINAL, TOTAL = "ordinal", "total_rows"

def in_order(columns) -> list:
    """Ascending, with missing values at the end."""
    return [F.col(c).asc_nulls_last() for c in columns]


def lay_out(df: DataFrame, order_by, within=(), ranges: int | None = None) -> DataFrame:
    """The rows sorted by ``within`` and ``order_by``, with their range and their place in it.

    Ties follow a row id that is written with the rows first: ranges must not change between two reads.
    Spark chooses the number of ranges from the size unless it is given.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    order = [*in_order([*within, *order_by]), F.col("_row")]
    ranged = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumns(
        {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    return stage(placed.drop("_row"), "ranges")


def with_ordinal(df: DataFrame, order_by, within=(), ordinal: str = ORDINAL, total: str = TOTAL,
                 ranges: int | None = None) -> DataFrame:
    """Add a 1-based position in the order of ``order_by``, and the number of rows.

    ``within`` restarts both per key; a null key is a key of its own, and nulls come last in the order.
    Keys are matched as a struct, which is never null itself.
    """
    if not order_by:
        raise ValueError("give at least one column to order by")
    placed = lay_out(df, order_by, within, ranges).withColumn(
        "_key", F.struct(F.lit(0).alias("_all"), *within))
    parts = placed.groupBy("_key", "_range").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    key = W.partitionBy("_key")  # one row per range of the key
    before = key.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("_key", "_range", "_first", F.sum("_rows").over(key).alias(total),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_place") - F.col("_first") + F.col("_offset") + 1
    return placed.join(offsets, ["_key", "_range"]).select(
        *df.columns, position.cast("long").alias(ordinal), total)


def weekly_ordinal(df: DataFrame, spec: SeriesSpec = WEEKLY) -> DataFrame:
    """Chronological position of weekly rows; rows of one week follow the series keys."""
    return with_ordinal(df, [*spec.order_by, *spec.keys])


def train_rows(total, test_size: float):
    """How many of the first rows form the training part."""
    return F.floor(F.lit(1 - test_size) * total)


@dataclass(frozen=True)
class Fold:
    """Ordinals up to ``train_end`` train; the next ones up to ``test_end`` test."""

    number: int
    train_end: int
    test_end: int


def expanding_folds(total: int, folds: int) -> list[Fold]:
    """``folds`` consecutive test blocks of equal size at the end, each trained on all before it."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    if total <= folds:
        raise ValueError(f"{folds} folds need more than {total} rows")
    size = total // (folds + 1)
    return [Fold(j, total - (folds - j) * size, total - (folds - j - 1) * size)
            for j in range(folds)]
