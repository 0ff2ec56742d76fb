"""Shape of the errors (histogram, density) and pairwise correlation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finite
from .clean import numeric_columns
from .quantiles import exact_medians

GRID_POINTS = 200
# Cells of a density in units of sqrt(2) bandwidths, powers summed per cell, and the reach of a kernel in bandwidths.
CELL, TERMS, REACH = 0.5, 16, 9.0


def errors(df: DataFrame, actual: str = "quantity", predicted: str = "prediction") -> DataFrame:
    """``error = actual - predicted`` where both are present."""
    error = finite(F.col(actual).cast("double") - F.col(predicted).cast("double"))
    return df.select(error.alias("error")).filter(F.col("error").isNotNull())


def error_histogram(df: DataFrame, actual: str = "quantity", predicted: str = "prediction",
                    bins: int = 30) -> DataFrame:
    """``bin, left_edge, right_edge, count`` for equal-width bins; the last one is closed.

    If all errors are equal the range is widened by one half on both sides, so exactly one bin is filled.
    """
    error = errors(df, actual, predicted)
    low, high = error.agg(F.min("error"), F.max("error")).first()
    if low is None:
        return error.sparkSession.createDataFrame(
            [], "bin int, left_edge double, right_edge double, count bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins

    def edge(number: Column) -> Column:
        return F.when(number == bins, F.lit(high)).otherwise(
            F.lit(low) + number * F.lit(width))

    guess = F.least(F.floor((F.col("error") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    # A quotient next to an edge may round across it: the edges decide.
    number = (guess - F.when(F.col("error") < edge(guess), 1).otherwise(0)
              + F.when((F.col("error") >= edge(guess + 1)) & (guess < bins - 1), 1).otherwise(0))
    counts = error.groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    every_bin = error.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counts, "bin", "left").select(
        "bin", edge(F.col("bin")).alias("left_edge"), edge(F.col("bin") + 1).alias("right_edge"),
        F.coalesce("count", F.lit(0)).alias("count"))


def error_summary(df: DataFrame, actual: str = "quantity",
                  predicted: str = "prediction") -> DataFrame:
    """Mean and median error."""
    error = errors(df, actual, predicted)
    median = exact_medians(error, ["error"])["error"]
    return error.agg(F.count("*").alias("n"), F.avg("error").alias("mean_error"),
                     F.lit(median).cast("double").alias("median_error"))


def error_density(df: DataFrame, actual: str = "quantity", predicted: str = "prediction",
                  points: int = GRID_POINTS, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density of the errors at ``points`` equally spaced values.

    The bandwidth follows Scott's rule. Errors are summed up in cells of half a kernel's scale as powers of
    their distance from the cell's centre, and only these sums meet the grid, through the Hermite series of
    the kernel. ``TERMS`` of them leave an error below 1e-14 of one kernel per error, and points more than
    ``REACH`` bandwidths from a cell's edge, where a kernel is below 1e-18, are left out. So a density costs
    one pass that combines on the map side, whatever the errors are. ``bins`` replaces the errors by the
    centres of that many equal bins first.
    """
    error = errors(df, actual, predicted)
    row = error.agg(F.count("*").alias("n"), F.stddev_samp("error").alias("s"),
                    F.min("error").alias("low"), F.max("error").alias("high")).first()
    if row["n"] < 2 or not row["s"]:
        return error.sparkSession.createDataFrame([], "point int, x double, density double")
    low, high = row["low"], row["high"]
    bandwidth = row["s"] * row["n"] ** (-1 / 5)
    step = (high - low) / (points - 1)
    if bins:
        width = (high - low) / bins
        number = F.least(F.floor((F.col("error") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        error = error.select((F.lit(low) + (number + 0.5) * F.lit(width)).alias("error"))

    scale = math.sqrt(2) * bandwidth
    cell = CELL * scale

    def in_reach(edge: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(float(points - 1)), edge / F.lit(step))).cast("int")

    centre = (F.col("cell") + 0.5) * F.lit(cell)  # from the lowest error
    far = F.lit(0.5 * cell + REACH * bandwidth)
    near = (_cell_moments(error.select((F.col("error") - F.lit(low)).alias("e")), cell, scale)
            .withColumn("centre", centre)
            .withColumn("point", F.explode(F.sequence(in_reach(F.col("centre") - far),
                                                      in_reach(F.col("centre") + far)))))
    y = (F.col("point") * F.lit(step) - F.col("centre")) / F.lit(scale)
    mass = near.groupBy("point").agg(F.sum(_hermite_sum(F.col("moments"), y)).alias("mass"))
    every = error.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    kernel = 1 / (row["n"] * bandwidth * math.sqrt(2 * math.pi))
    return every.join(mass, "point", "left").select(
        "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        (F.coalesce("mass", F.lit(0.0)) * F.lit(kernel)).alias("density"))


def _cell_moments(error: DataFrame, cell: float, scale: float) -> DataFrame:
    """``cell, moments``: sums of t**k / k! over the errors of a cell, t their distance from its centre."""
    number = F.floor(F.col("e") / F.lit(cell))
    placed = error.select(number.alias("cell"), ((F.col("e") - (number + 0.5) * F.lit(cell)) / F.lit(scale)).alias("t"))
    power, sums = F.lit(1.0), []
    for k in range(TERMS):
        sums.append(F.sum(power / F.lit(float(math.factorial(k)))))
        power = power * F.col("t")
    return placed.groupBy("cell").agg(F.array(*sums).alias("moments"))


def _hermite_sum(moments: Column, y: Column) -> Column:
    """The sum of moments times the Hermite functions of ``y``, each made from the two before it."""
    start = F.struct(F.exp(-y * y).alias("now"), F.lit(0.0).alias("before"), F.lit(0.0).alias("k"),
                     F.lit(0.0).alias("total"))

    def add(state: Column, moment: Column) -> Column:
        return F.struct((2 * y * state["now"] - 2 * state["k"] * state["before"]).alias("now"),
                        state["now"].alias("before"), (state["k"] + 1).alias("k"),
                        (state["total"] + moment * state["now"]).alias("total"))

    return F.aggregate(moments, start, add, lambda state: state["total"])


def correlation_matrix(df: DataFrame, cols: list[str] | None = None,
                       threshold: float = 0.1) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both values are present.

    Returns the lower triangle as ``col_a, col_b, r``. Correlations weaker than ``threshold``, and those
    of a constant column, are 0.
    """
    cols = cols or numeric_columns(df)
    if len(cols) < 2:
        raise ValueError("at least two numeric columns are needed")
    values = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in cols])
    both = _co_moments(values, cols)
    # The spread of a constant may come out as rounding noise: its range tells for sure.
    varies = (F.col("low_a") < F.col("high_a")) & (F.col("low_b") < F.col("high_b"))
    r = F.when(varies, F.try_divide(F.col("cab"), F.sqrt("maa") * F.sqrt("mbb")))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(r, F.lit(0.0))))
    shown = (F.abs(r) >= threshold) | (r == 1)
    names = F.array(*[F.lit(c) for c in cols])
    return both.select(names[F.col("a")].alias("col_a"), names[F.col("b")].alias("col_b"),
                       F.when(shown, r).otherwise(F.lit(0.0)).alias("r"))


class _CoMoments:
    """Means, centred second moments and ranges of every pair, over the rows that have both values.

    Every batch is centred on its own means before anything is squared, and batches are merged by their
    means, so nothing cancels however far the values lie from zero or from each other.
    """

    NAMES = ("n", "mean_a", "mean_b", "maa", "mbb", "cab", "low_a", "high_a", "low_b", "high_b")

    def __init__(self, columns: int):
        self.a, self.b = np.tril_indices(columns, -1)
        pairs = len(self.a)
        self.sums = {name: np.zeros(pairs) for name in self.NAMES}
        for name in ("low_a", "low_b"):
            self.sums[name][:] = np.inf
        for name in ("high_a", "high_b"):
            self.sums[name][:] = -np.inf

    def add(self, x: np.ndarray) -> None:
        there = ~np.isnan(x)
        one = {name: np.empty(len(self.a)) for name in self.NAMES}
        # Columns with the same gaps share their rows, so their pairs come from one matrix product.
        _, kind = np.unique(np.packbits(there, axis=0), axis=1, return_inverse=True)
        kind = np.ravel(kind)
        for g in range(kind.max() + 1):
            for h in range(g + 1):
                pairs = np.flatnonzero(((kind[self.a] == g) & (kind[self.b] == h))
                                       | ((kind[self.a] == h) & (kind[self.b] == g)))
                if len(pairs):
                    rows = there[:, kind == g][:, 0] & there[:, kind == h][:, 0]
                    used = np.unique(np.concatenate([self.a[pairs], self.b[pairs]]))
                    self._fill(one, pairs, x[np.ix_(rows, used)], used)
        self._merge(one)

    def _fill(self, one: dict, pairs: np.ndarray, x: np.ndarray, used: np.ndarray) -> None:
        i, j = np.searchsorted(used, self.a[pairs]), np.searchsorted(used, self.b[pairs])
        n = len(x)
        mean = x.mean(0) if n else np.zeros(len(used))
        centred = x - mean
        products = centred.T @ centred
        low, high = (x.min(0), x.max(0)) if n else (np.full(len(used), np.inf), np.full(len(used), -np.inf))
        for name, value in zip(self.NAMES, (
                np.full(len(pairs), float(n)), mean[i], mean[j], products[i, i], products[j, j],
                products[i, j], low[i], high[i], low[j], high[j]), strict=True):
            one[name][pairs] = value

    def _merge(self, one: dict) -> None:
        all_ = self.sums
        n = all_["n"] + one["n"]
        share = np.divide(one["n"], n, out=np.zeros_like(n), where=n > 0)
        da, db = one["mean_a"] - all_["mean_a"], one["mean_b"] - all_["mean_b"]
        weight = all_["n"] * share
        for name, product in (("maa", da * da), ("mbb", db * db), ("cab", da * db)):
            all_[name] += one[name] + weight * product
        all_["mean_a"] += da * share
        all_["mean_b"] += db * share
        all_["n"] = n
        for name in ("low_a", "low_b"):
            all_[name] = np.minimum(all_[name], one[name])
        for name in ("high_a", "high_b"):
            all_[name] = np.maximum(all_[name], one[name])


def _co_moments(values: DataFrame, cols: list[str]) -> DataFrame:
    """One row per pair; every task sends one row per pair, merged by their means after the shuffle."""
    names, count = _CoMoments.NAMES, len(cols)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = _CoMoments(count)
        for batch in batches:
            if len(batch):
                held.add(batch.to_numpy(dtype="float64", na_value=np.nan))
        yield pd.DataFrame({"a": held.a, "b": held.b, **held.sums})

    schema = "a int, b int, " + ", ".join(f"{name} double" for name in names)
    nothing = _CoMoments(count)  # so that an empty table has all its pairs
    none = values.sparkSession.createDataFrame(pd.DataFrame(
        {"a": nothing.a, "b": nothing.b, **nothing.sums}), schema)
    parts = values.mapInPandas(moments, schema).unionByName(none)
    pair = W.partitionBy("a", "b")
    n = F.sum("n").over(pair)
    parts = parts.withColumns({
        f"to_{c}": F.col(f"mean_{c}") - F.try_divide(F.sum(F.col("n") * F.col(f"mean_{c}")).over(pair), n)
        for c in ("a", "b")})

    def merged(inner: str, x: str, y: str) -> Column:
        return F.sum(F.col(inner) + F.coalesce(F.col("n") * F.col(f"to_{x}") * F.col(f"to_{y}"), F.lit(0.0)))

    return parts.groupBy("a", "b").agg(
        merged("maa", "a", "a").alias("maa"), merged("mbb", "b", "b").alias("mbb"), merged("cab", "a", "b").alias("cab"),
        *[F.min(c).alias(c) for c in ("low_a", "low_b")], *[F.max(c).alias(c) for c in ("high_a", "high_b")])
