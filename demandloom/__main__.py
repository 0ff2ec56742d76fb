"""Command line: ``python -m demandloom --transactions ... --stores ... --products ... --out ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .models.train import MODELS
from .plans.run import run_forecast
from .sources import drop_staged, load_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="demandloom", description="Weekly sales forecast")
    for name in ("transactions", "stores", "products"):
        parser.add_argument(f"--{name}", required=True, help=f"Parquet path of the {name}")
    parser.add_argument("--out", required=True, help="folder for all results")
    parser.add_argument("--year", type=int, default=2022)
    parser.add_argument("--model-type", default="lightgbm", choices=sorted(MODELS))
    parser.add_argument("--cv-folds", type=int, default=5)
    parser.add_argument("--forecast-weeks", type=int, default=5)
    parser.add_argument("--n-estimators", type=int, default=None)
    parser.add_argument("--digits", type=int, default=None, help="decimals of weekly sums")
    parser.add_argument("--reports", action="store_true", help="write the report tables too")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("demandloom").getOrCreate()
    try:
        tables = load_tables(spark, args.transactions, args.stores, args.products)
        result = run_forecast(tables, args.out, args.year, args.model_type, args.cv_folds,
                              args.forecast_weeks, args.n_estimators, args.reports, args.digits)
        total = result.summary.first()
        print(f"{total['total_units']} units forecast for {total['stores']} stores and "
              f"{total['products']} products, written to {result.forecast_path}")
    finally:
        drop_staged(spark)


if __name__ == "__main__":
    main()
