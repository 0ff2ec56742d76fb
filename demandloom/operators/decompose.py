"""Classical seasonal decomposition, for one series or many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finite
from ..sources.staging import stage
from .blocks import block_series, in_blocks, leave_blocks, over_blocks
from .clean import parse_dates
from .ordinal import ORDINAL, TOTAL, with_ordinal
from .sliding import CELLS_FROM, sliding_statistics


def _inside_frame(period: int):
    half = period // 2
    return (F.col(ORDINAL) > half) & (F.col(ORDINAL) <= F.col(TOTAL) - half)


def centred_average(numbered: DataFrame, value: str, period: int, within=(),
                    name: str = "trend") -> DataFrame:
    """Centred moving average over ``period`` positions, null where the frame is not full.

    An even period spans one more point and weighs both ends by one half.
    """
    half = period // 2

    def average(series, total=None):
        total = F.sum(value).over(series.rowsBetween(-half, half)) if total is None else total
        if period % 2 == 0:
            ends = F.lag(value, half).over(series) + F.lead(value, half).over(series)
            total = total - 0.5 * ends
        return {name: F.when(_inside_frame(period), total / F.lit(float(period)))}

    if period < CELLS_FROM:
        return over_blocks(numbered, average, half, half, within)
    # The window that ends half a period later.
    copied = sliding_statistics(in_blocks(numbered, half, half), [*within, "_block"], ORDINAL, F.col(value),
                                [2 * half + 1], ["_around"])
    series = block_series(within)
    total = F.lead("_around", half).over(series)["sum"]
    return leave_blocks(copied.withColumns(average(series, total))).drop("_around")


def seasonal_index(detrended: DataFrame, value: str, period: int, model: str = "additive",
                   within=()) -> DataFrame:
    """Mean of the detrended value per phase, centred on 0 (additive) or 1 (multiplicative)."""
    phases = detrended.groupBy(*within, F.pmod(F.col(ORDINAL) - 1, period).alias("phase")).agg(
        F.avg(value).alias("_mean"))
    level = F.avg("_mean").over(W.partitionBy(*within))  # ``period`` rows per series
    centred = (F.col("_mean") - level if model == "additive"
               else F.try_divide(F.col("_mean"), level))
    return phases.select(*within, "phase", centred.alias("seasonal"))


def daily_totals(df: DataFrame, date_col: str, value_col: str, keys=()) -> DataFrame:
    """One row per observed date and key; dates without rows stay absent."""
    df = parse_dates(df, (date_col,))
    known = df.filter(F.col(date_col).isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    value = finite(F.col(value_col).cast("double"))
    return known.groupBy(*keys, date_col).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("observed"))


def decompose_time_series(df: DataFrame, date_col: str = "transaction_date",
                          value_col: str = "quantity", period: int = 52,
                          model: str = "additive", keys=()) -> DataFrame:
    """``observed, trend, seasonal, resid`` per observed date of each series.

    A series is rejected if it is shorter than two periods, or has a value that is not positive under the
    multiplicative model. A single series then raises. With ``keys`` a column ``reason`` says ``short``
    or ``not positive``, and the rejected series keep their rows without trend, season and residual.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"model must be 'additive' or 'multiplicative', not {model!r}")
    if period < 1:
        raise ValueError("period must be positive")
    keys = list(keys)
    totals = stage(daily_totals(df, date_col, value_col, keys), "daily-totals")
    lengths = totals.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("observed").alias("_low"))
    if not keys:
        _check_series(*lengths.first(), period, model)
    low = F.col("_low") <= 0 if model == "multiplicative" else F.lit(False)
    reason = F.when(F.col("_n") < 2 * period, "short").when(low, "not positive")

    numbered = with_ordinal(totals, [date_col], tuple(keys))
    with_trend = centred_average(numbered, "observed", period, keys)
    if keys:
        with_trend = with_trend.join(lengths.select(*keys, reason.alias("reason")), keys).withColumn(
            "trend", F.when(F.col("reason").isNull(), F.col("trend")))
    observed, trend, seasonal = F.col("observed"), F.col("trend"), F.col("seasonal")
    additive = model == "additive"
    detrended = with_trend.withColumn(
        "_detrended", observed - trend if additive else F.try_divide(observed, trend))
    usable = detrended.filter("reason is null") if keys else detrended
    index = seasonal_index(usable, "_detrended", period, model, keys)
    resid = (observed - trend - seasonal if additive
             else F.try_divide(observed, F.col("trend") * seasonal))
    phase = F.pmod(F.col(ORDINAL) - 1, period)
    return (
        with_trend.withColumn("phase", phase).join(index, [*keys, "phase"], "left")
        .select(*keys, date_col, "observed", "trend", "seasonal", resid.alias("resid"),
                *(["reason"] if keys else []))
    )


def _check_series(length: int, smallest: float, period: int, model: str) -> None:
    if not length or length < 2 * period:
        raise ValueError(f"two periods need {2 * period} dates, but a series has {length or 0}")
    if model == "multiplicative" and smallest <= 0:
        raise ValueError("the multiplicative model needs positive values")
