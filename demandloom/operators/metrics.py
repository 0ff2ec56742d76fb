"""Error measures as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _metric_columns(actual: Column, predicted: Column) -> list[Column]:
    """MAE, MSE, RMSE, R2 and MAPE over rows where both values are present."""
    both = actual.isNotNull() & predicted.isNotNull()
    y = F.when(both, actual.cast("double"))
    error = y - predicted.cast("double")
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    r2 = F.when(spread == 0, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.try_divide(squares, spread))
    # A zero actual has no percentage error and is left out.
    percentage = F.try_divide(F.abs(error), F.abs(y))
    return [
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r2.alias("r2"),
        F.avg(percentage).alias("mape"),
    ]


def regression_metrics(df: DataFrame, actual: str = "quantity", predicted: str = "prediction",
                       groupby=()) -> DataFrame:
    """``n, mae, mse, rmse, r2, mape`` over the frame, or per group."""
    return df.groupBy(*groupby).agg(*_metric_columns(F.col(actual), F.col(predicted)))


def fold_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of MAE and RMSE over the folds."""
    return fold_metrics.agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
        F.stddev_pop("mae").alias("mae_std"), F.stddev_pop("rmse").alias("rmse_std"))


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Total forecast units and the number of stores and products."""
    return forecast.agg(
        F.sum("quantidade").alias("total_units"),
        F.count_distinct("pdv").alias("stores"),
        F.count_distinct("produto").alias("products"))
