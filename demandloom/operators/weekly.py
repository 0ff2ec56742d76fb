"""The weekly series: rollup, lags, rolling statistics, last observation."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finite
from ..spec import (MEASURES, PRODUCT, PRODUCT_ATTRIBUTES, STORE, STORE_ATTRIBUTES, WEEKLY,
                    SeriesSpec)
from .blocks import in_blocks, leave_blocks, over_long_series
from .ordinal import ORDINAL, TOTAL, in_order, with_ordinal
from .sliding import CELLS_FROM, sliding_statistics
from .star import assert_unique


def weekly_rollup(sales: DataFrame, spec: SeriesSpec = WEEKLY,
                  measures: tuple[str, ...] = MEASURES, digits: int | None = None) -> DataFrame:
    """Sums per series and week; rows with a null key are dropped, an all-null sum is 0.

    Partial sums leave the map side, so a hot series costs no more to shuffle than any other. A sum of
    doubles depends on the order of its terms in the last bits: rounding it to the ``digits`` that the
    measures carry makes it, and every ratio built on it, the same in every run.
    """
    grain = list(spec.grain)
    known = sales
    for key in grain:
        known = known.filter(F.col(key).isNotNull())
    sums = []
    for m in measures:
        total = F.coalesce(F.sum(finite(F.col(m).cast("double"))), F.lit(0.0))
        sums.append((total if digits is None else F.round(total, digits)).alias(m))
    return known.groupBy(*grain).agg(*sums, F.avg("is_weekend").alias("is_weekend"))


def attach_attributes(weekly: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Store and product attributes for every weekly row.

    Joining after the rollup moves weekly rows instead of transactions, and equals taking the first
    attribute per group because the dimension keys are unique.
    """
    assert_unique(stores, "pdv", "stores")
    assert_unique(products, "produto", "products")
    store_side = stores.select(F.col("pdv").alias(STORE), *STORE_ATTRIBUTES)
    product_side = products.select(F.col("produto").alias(PRODUCT), *PRODUCT_ATTRIBUTES)
    return weekly.join(store_side, STORE, "left").join(product_side, PRODUCT, "left").select(
        *weekly.columns, *STORE_ATTRIBUTES, *PRODUCT_ATTRIBUTES)


def series_window(spec: SeriesSpec) -> WindowSpec:
    return W.partitionBy(*spec.keys).orderBy(*in_order(spec.order_by))


def lag_expressions(spec: SeriesSpec, lags, series: WindowSpec | None = None) -> dict:
    series = series or series_window(spec)
    return {f"{spec.target}_lag_{k}": F.lag(spec.target, k).over(series) for k in lags}


def rolling_expressions(spec: SeriesSpec, windows, include_current: bool = True,
                        series: WindowSpec | None = None) -> dict:
    """Trailing statistics over observed rows; null (a lone value has no deviation) becomes 0."""
    series = series or series_window(spec)
    value = finite(F.col(spec.target).cast("double"))
    statistics = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    columns = {}
    for size in windows:
        frame = (series.rowsBetween(1 - size, 0) if include_current
                 else series.rowsBetween(-size, -1))
        for name, function in statistics.items():
            columns[f"{spec.target}_roll_{name}_{size}"] = F.coalesce(
                function(value).over(frame), F.lit(0.0))
    return columns


def long_rolling(df: DataFrame, spec: SeriesSpec, partition, windows, include_current: bool) -> DataFrame:
    """The same columns for long windows, at a cost per row that does not grow with them.

    ``df`` has the position of every row in its series; ``partition`` is one task's share of a series.
    """
    names = [f"_{size}" for size in windows]
    value = finite(F.col(spec.target).cast("double"))
    made = sliding_statistics(df, partition, ORDINAL, value, windows, names)
    if not include_current:
        series = W.partitionBy(*partition).orderBy(ORDINAL)
        made = made.withColumns({n: F.lag(n, 1).over(series) for n in names})
    columns = {}
    for size, name in zip(windows, names, strict=True):
        found = F.col(name)
        for statistic, result in {
                "mean": F.try_divide(found["sum"], found["n"]),
                "std": F.when(found["n"] > 1, F.sqrt(found["m2"] / (found["n"] - 1))),
                "min": found["min"], "max": found["max"]}.items():
            columns[f"{spec.target}_roll_{statistic}_{size}"] = F.coalesce(result, F.lit(0.0))
    return made.withColumns(columns).drop(*names)


def create_lag_features(df: DataFrame, groupby_cols, target_col: str = "quantity",
                        lags=(1, 2, 3, 4), order_by=("transaction_date",),
                        long_series: bool = False) -> DataFrame:
    """Values of earlier *observed* rows of the same series; gaps are not filled.

    Weekly series are short. Where one series may hold much of the table, as with single transactions,
    ``long_series`` spreads it over many tasks.
    """
    spec = SeriesSpec(tuple(groupby_cols), tuple(order_by), target_col)
    if long_series:
        return over_long_series(df, spec.keys, spec.order_by,
                                lambda series: lag_expressions(spec, lags, series), max(lags))
    return df.withColumns(lag_expressions(spec, lags))


def create_rolling_features(df: DataFrame, groupby_cols, target_col: str = "quantity",
                            windows=(2, 4, 8, 12), order_by=("transaction_date",),
                            include_current: bool = True, long_series: bool = False) -> DataFrame:
    """Trailing mean, deviation, minimum and maximum over the last observed rows.

    The current row counts by default; ``include_current=False`` looks at earlier rows only.
    Missing values in any ``roll_`` column already present become 0 as well. ``long_series`` is as for
    lags. The cost of windows of ``CELLS_FROM`` rows or more does not grow with their length.
    """
    spec = SeriesSpec(tuple(groupby_cols), tuple(order_by), target_col)
    df = df.withColumns({
        c: F.coalesce(F.col(c), F.lit(0)) for c in df.columns if "roll_" in c})
    short = [w for w in windows if w < CELLS_FROM]
    long = [w for w in windows if w >= CELLS_FROM]
    if not long_series:
        made = df.withColumns(rolling_expressions(spec, short, include_current))
        if long:
            numbered = made.withColumn(ORDINAL, F.row_number().over(series_window(spec)))
            made = long_rolling(numbered, spec, spec.keys, long, include_current).drop(ORDINAL)
    elif not long:
        return over_long_series(
            df, spec.keys, spec.order_by,
            lambda series: rolling_expressions(spec, windows, include_current, series),
            max(windows))
    else:
        partition = [*spec.keys, "_block"]
        copied = in_blocks(with_ordinal(df, spec.order_by, spec.keys), max(windows), 0)
        made = long_rolling(copied, spec, partition, long, include_current)
        series = W.partitionBy(*partition).orderBy(ORDINAL)
        made = leave_blocks(made.withColumns(
            rolling_expressions(spec, short, include_current, series))).drop(ORDINAL, TOTAL)
    return made.select(*df.columns, *rolling_expressions(spec, windows, include_current))


def last_observation(df: DataFrame, spec: SeriesSpec = WEEKLY) -> DataFrame:
    """The latest row of every series."""
    latest = W.partitionBy(*spec.keys).orderBy(*[F.col(c).desc_nulls_last()
                                                  for c in spec.order_by])
    return (df.withColumn("_recency", F.row_number().over(latest))
              .filter("_recency = 1").drop("_recency"))


def distinct_series(df: DataFrame, spec: SeriesSpec = WEEKLY) -> DataFrame:
    return df.select(*spec.keys).distinct()
