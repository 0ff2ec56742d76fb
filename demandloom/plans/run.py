"""A whole run: clean, build features, train, forecast, write."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..models.predict import generate_forecast
from ..models.train import TrainingResult, feature_importance, save_model, train_model
from ..operators.clean import preprocess_pdv, preprocess_products, preprocess_transactions
from ..operators.metrics import forecast_summary
from ..operators.reports import (category_distribution, sales_trend, seasonal_pattern,
                                 top_features)
from ..operators.star import attach
from ..sources import write_features, write_forecast_csv, write_processed
from ..sources.tables import RetailTables
from ..spec import PRODUCT, STORE
from .features import create_features


@dataclass
class RunResult:
    forecast: DataFrame
    summary: DataFrame
    training: TrainingResult
    forecast_path: str
    model_path: str
    reports: dict[str, DataFrame] = field(default_factory=dict)


def sales_reports(sales: DataFrame, stores: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the charts of a run."""
    by_product = attach(sales, products, PRODUCT, "produto", "inner")
    by_store = attach(sales, stores, STORE, "pdv", "inner")
    return {
        "sales_trend": sales_trend(sales),
        "categoria_distribution": category_distribution(by_product, "categoria",
                                                        dimension=products),
        "categoria_pdv_distribution": category_distribution(by_store, "categoria_pdv",
                                                            dimension=stores),
        "seasonal_pattern": seasonal_pattern(sales),
    }


def run_forecast(tables: RetailTables, folder: str, year: int | None = 2022,
                 model_type: str = "lightgbm", cv_folds: int = 5, forecast_weeks: int = 5,
                 n_estimators: int | None = None, reports: bool = False,
                 digits: int | None = None) -> RunResult:
    """Everything from raw tables to the forecast file, under ``folder``.

    ``digits`` rounds the weekly sums to the decimals their measures carry, which makes them independent of
    the order of summation.

    The cleaned and feature tables are written first and read back, so later steps start from stored
    data and not from the raw scan.
    """
    spark = tables.transactions.sparkSession
    write_processed(folder, preprocess_transactions(tables.transactions, year),
                    preprocess_pdv(tables.stores), preprocess_products(tables.products))
    sales = spark.read.parquet(f"{folder}/transactions_processed.parquet")
    stores = spark.read.parquet(f"{folder}/pdvs_processed.parquet")
    products = spark.read.parquet(f"{folder}/products_processed.parquet")

    write_features(create_features(sales, stores, products, digits=digits), folder)
    features = spark.read.parquet(f"{folder}/feature_data.parquet")

    training = train_model(features, model_type=model_type, cv=cv_folds,
                           n_estimators=n_estimators, stored=True)
    model_path = save_model(
        training.model, f"{folder}/models/{model_type}_sales_forecast_{int(time.time())}_{uuid.uuid4().hex[:8]}")
    path = write_forecast_csv(generate_forecast(training.model, features, forecast_weeks),
                              f"{folder}/predictions")
    key = {"bigint": "long"}.get(dict(features.dtypes)[STORE], "string")
    item = {"bigint": "long"}.get(dict(features.dtypes)[PRODUCT], "string")
    forecast = (spark.read.option("sep", ";").option("header", True)
                .schema(f"semana int, pdv {key}, produto {item}, quantidade long").csv(path))
    tables_out = {}
    if reports:
        tables_out = sales_reports(sales, stores, products)
        tables_out["feature_importance"] = top_features(feature_importance(training.model))
        for name, table in tables_out.items():
            table.write.mode("overwrite").parquet(f"{folder}/reports/{name}.parquet")
    return RunResult(forecast, forecast_summary(forecast), training, path, model_path, tables_out)
