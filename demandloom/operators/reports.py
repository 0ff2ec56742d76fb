"""Summary tables: trend, category distribution, seasonality, forecast against actual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finite
from .clean import parse_dates


def _value(name: str) -> Column:
    return finite(F.col(name).cast("double"))


def _total(name: str) -> Column:
    """A sum where nothing to add is 0."""
    return F.coalesce(F.sum(_value(name)), F.lit(0.0))


def _day(date: Column) -> Column:
    return F.to_date(date)


def _sunday(date: Column) -> Column:
    return F.date_add(F.to_date(F.date_trunc("week", date)), 6)


# Frequency: label of a date, label of the bucket before, distance between labels.
_BUCKETS = {
    "D": (_day, lambda label: F.date_sub(label, 1), "interval 1 day"),
    "W": (_sunday, lambda label: F.date_sub(label, 7), "interval 7 days"),
    "M": (F.last_day, lambda label: F.add_months(label, -1), "interval 1 month"),
}


def sales_trend(df: DataFrame, time_col: str = "transaction_date", value_col: str = "quantity",
                freq: str = "W") -> DataFrame:
    """Totals per day, week (labelled by its Sunday) or month (by its last day), gaps as 0."""
    if freq not in _BUCKETS:
        raise ValueError(f"freq must be one of {sorted(_BUCKETS)}, not {freq!r}")
    label, previous, step = _BUCKETS[freq]
    df = parse_dates(df, (time_col,))
    totals = (df.filter(F.col(time_col).isNotNull())
                .groupBy(label(F.col(time_col)).alias("bucket"))
                .agg(_total(value_col).alias("_total")))
    # One row per bucket is left here, so ordering them all is bounded by the calendar. Each bucket is
    # followed by the empty ones up to the next.
    upcoming = F.lead("bucket").over(W.orderBy("bucket"))
    until = F.coalesce(previous(upcoming), F.col("bucket"))
    if freq == "M":
        first, until = F.trunc("bucket", "month"), F.trunc(until, "month")
    else:
        first = F.col("bucket")
    filled = totals.withColumn("_until", until).withColumn(
        "_run", F.sequence(first, F.col("_until"), F.expr(step)))
    period = F.last_day("_day") if freq == "M" else F.col("_day")
    return (filled.withColumn("_day", F.explode("_run")).withColumn("period", period)
            .select("period", F.when(F.col("period") == F.col("bucket"), F.col("_total"))
                    .otherwise(0.0).alias("total")))


def category_distribution(df: DataFrame, cat_col: str, value_col: str = "quantity",
                          top_n: int = 10, dimension: DataFrame | None = None) -> DataFrame:
    """The ``top_n`` categories by total; ties are ordered by name.

    With ``dimension``, categories of the dimension that never sold take part with a total of 0.
    """
    totals = (df.filter(F.col(cat_col).isNotNull()).groupBy(cat_col)
                .agg(_total(value_col).alias("total")))
    if dimension is not None:
        listed = dimension.select(cat_col).filter(F.col(cat_col).isNotNull()).distinct()
        totals = listed.join(totals, cat_col, "full_outer").select(
            cat_col, F.coalesce("total", F.lit(0.0)).alias("total"))
    return totals.orderBy(F.col("total").desc(), F.col(cat_col)).limit(top_n)


def seasonal_pattern(df: DataFrame, date_col: str = "transaction_date",
                     value_col: str = "quantity", period: str = "weekly") -> DataFrame:
    """Mean row value per weekday (``daily``), ISO week (``weekly``) or month (``monthly``)."""
    df = parse_dates(df, (date_col,))
    date = F.col(date_col)
    parts = {
        "daily": (F.weekday(date), F.date_format(date, "EEEE")),
        "weekly": (F.weekofyear(date), F.weekofyear(date)),
        "monthly": (F.month(date), F.date_format(date, "MMMM")),
    }
    if period not in parts:
        raise ValueError(f"period must be one of {sorted(parts)}, not {period!r}")
    ordinal, label = parts[period]
    return (df.filter(date.isNotNull())
              .groupBy(ordinal.alias("position"), label.alias("period"))
              .agg(F.avg(_value(value_col)).alias("mean_value"))
              .orderBy("position"))


def forecast_vs_actual(actual: DataFrame, forecast: DataFrame, date_col="week",
                       value_col: str = "quantity", groupby: str | None = None,
                       forecast_value_col: str | None = None) -> DataFrame:
    """Both totals per period, and per group if one is given, side by side.

    ``date_col`` may be several columns. A period that only one side has keeps a null on the other.
    """
    keys = [date_col] if isinstance(date_col, str) else list(date_col)
    keys += [groupby] if groupby else []

    def totals(df: DataFrame, column: str, name: str) -> DataFrame:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
        return df.groupBy(*keys).agg(_total(column).alias(name))

    return totals(actual, value_col, "actual").join(
        totals(forecast, forecast_value_col or value_col, "forecast"), keys, "full_outer")


def forecast_vs_actual_long(aligned: DataFrame) -> DataFrame:
    """The aligned table as one row per period and kind, absent values left out."""
    keys = [c for c in aligned.columns if c not in ("actual", "forecast")]
    return aligned.unpivot(keys, ["actual", "forecast"], "kind", "value").filter(
        F.col("value").isNotNull())


def top_features(importance: DataFrame, top_n: int = 20) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(top_n)
