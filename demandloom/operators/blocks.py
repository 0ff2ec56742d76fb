"""Row-based windows over series of any length.

A window partition is one task's work, so a series that holds much of a table would be one long task.
Here a numbered series is cut into blocks of consecutive rows; the rows next to a cut are copied to the
block that looks back or ahead at them, and only the rows at home in a block are kept afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordinal import ORDINAL, TOTAL, with_ordinal

BLOCK = 65_536


def in_blocks(numbered: DataFrame, back: int, ahead: int, block: int = BLOCK) -> DataFrame:
    """Rows with their block, copied to every other block that reads them; ``leave_blocks`` ends it."""
    block = max(block, back, ahead)
    position = F.col(ORDINAL) - 1

    def block_of(p: Column) -> Column:
        return F.floor(p / F.lit(block))

    readers = F.array_distinct(F.array(
        block_of(position), block_of(position + back), block_of(position - ahead)))
    return (numbered.withColumn("_home", block_of(position))
            .withColumn("_block", F.explode(readers)))


def leave_blocks(copied: DataFrame) -> DataFrame:
    return copied.filter(F.col("_block") == F.col("_home")).drop("_home", "_block")


def block_series(within=()) -> WindowSpec:
    return W.partitionBy(*within, "_block").orderBy(ORDINAL)


def over_blocks(numbered: DataFrame, columns, back: int, ahead: int, within=(),
                block: int = BLOCK) -> DataFrame:
    """Add window columns that reach at most ``back`` rows back and ``ahead`` rows ahead.

    ``columns`` maps a window specification to named expressions; ``numbered`` has 1-based ordinals.
    """
    copied = in_blocks(numbered, back, ahead, block)
    return leave_blocks(copied.withColumns(columns(block_series(within))))


def over_long_series(df: DataFrame, keys, order_by, columns, back: int, ahead: int = 0,
                     block: int = BLOCK) -> DataFrame:
    """The same for rows that are not numbered yet: series ``keys``, in the order of ``order_by``."""
    numbered = with_ordinal(df, order_by, tuple(keys))
    return over_blocks(numbered, columns, back, ahead, keys, block).drop(ORDINAL, TOTAL)
