"""Time-ordered splits and folds.

Labels need the few rows at the cuts only: these are selected, and the labels are comparisons with them, so
rows are neither moved nor written. Numbers for all rows are a sort, and made on request.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import WEEKLY, SeriesSpec
from .ordinal import ORDINAL, TOTAL, expanding_folds, train_rows, weekly_ordinal
from .selection import count_cuts, find_cuts

PASSED = "_passed"


def time_split(df: DataFrame, test_size: float = 0.2, spec: SeriesSpec = WEEKLY,
               numbered: bool = False) -> DataFrame:
    """Label the first ``1 - test_size`` of the rows ``train`` and the rest ``test``.

    ``df`` is read a few times, so it should be a stored table. ``numbered`` adds the position of every row.
    """
    if numbered:
        rows = weekly_ordinal(df, spec)
        is_train = F.col(ORDINAL) <= train_rows(F.col(TOTAL), test_size)
        return rows.withColumn("split", F.when(is_train, "train").otherwise("test")).drop(TOTAL)
    order = [*spec.order_by, *spec.keys]
    total = df.count()
    cuts = find_cuts(df, order, [math.floor((1 - test_size) * total)], total)
    labelled = count_cuts(df, cuts, order, PASSED)
    return labelled.withColumn("split", F.when(F.col(PASSED) == 0, "train").otherwise("test")).drop(PASSED)


def time_folds(df: DataFrame, folds: int = 5, spec: SeriesSpec = WEEKLY, numbered: bool = False) -> DataFrame:
    """Every row once per fold it takes part in, labelled ``train`` or ``test``.

    ``df`` is read a few times, so it should be a stored table. ``numbered`` adds the position of every row.
    """
    if folds < 2:
        raise ValueError("at least two folds are needed")
    if numbered:
        return _numbered_folds(df, folds, spec)
    order = [*spec.order_by, *spec.keys]
    total = df.count()
    ranks = [fold.train_end for fold in expanding_folds(total, folds)]
    passed = F.col(PASSED)  # a row behind j cuts is tested in fold j - 1 and trains the later ones
    return (
        count_cuts(df, find_cuts(df, order, ranks, total), order, PASSED)
        .withColumn("fold", F.explode(F.sequence(F.greatest(passed - 1, F.lit(0)), F.lit(folds - 1))))
        .withColumn("part", F.when(passed <= F.col("fold"), "train").otherwise("test"))
        .drop(PASSED)
    )


def _numbered_folds(df: DataFrame, folds: int, spec: SeriesSpec) -> DataFrame:
    total, fold = F.col(TOTAL), F.col("fold")
    size = F.floor(total / (folds + 1))
    too_few = F.raise_error(F.lit(f"{folds} folds need more rows")).cast("long")
    train_end = F.when(total <= folds, too_few).otherwise(total - (F.lit(folds) - fold) * size)
    return (
        weekly_ordinal(df, spec)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        .withColumn("_train_end", train_end)
        .filter(F.col(ORDINAL) <= F.col("_train_end") + size)
        .withColumn("part", F.when(F.col(ORDINAL) <= F.col("_train_end"), "train")
                    .otherwise("test"))
        .drop("_train_end", TOTAL)
    )
