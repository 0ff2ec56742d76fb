"""Where results go: Parquet for tables, delimited text for the forecast."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORECAST_COLUMNS = ("semana", "pdv", "produto", "quantidade")


def _write_by_week(df: DataFrame, path: str) -> None:
    # The rebalance hint lets AQE split a hot week over several tasks and merge the thin ones,
    # so no task writes a whole hot partition and no week ends up as thousands of tiny files.
    (df.hint("rebalance", "year", "week")
       .write.mode("overwrite").partitionBy("year", "week").parquet(path))


def write_processed(folder: str, transactions: DataFrame | None = None,
                    stores: DataFrame | None = None, products: DataFrame | None = None) -> None:
    """Overwrite the cleaned tables; each one is optional."""
    if transactions is not None:
        _write_by_week(transactions, f"{folder}/transactions_processed.parquet")
    if stores is not None:
        stores.write.mode("overwrite").parquet(f"{folder}/pdvs_processed.parquet")
    if products is not None:
        products.write.mode("overwrite").parquet(f"{folder}/products_processed.parquet")


def write_features(features: DataFrame, folder: str) -> None:
    _write_by_week(features, f"{folder}/feature_data.parquet")


def write_forecast_csv(forecast: DataFrame, folder: str, at: datetime | None = None) -> str:
    """Write ``semana;pdv;produto;quantidade`` with a header; returns the directory written.

    Its name has the time and a part of its own, so two runs in one second don't meet.
    """
    at = at or datetime.now()
    path = f"{folder}/sales_forecast_{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}.csv"
    (forecast.select(*FORECAST_COLUMNS)
        .withColumn("quantidade", F.col("quantidade").cast("long"))
        .write.option("sep", ";").option("header", True)
        .option("encoding", "UTF-8").csv(path))
    return path
