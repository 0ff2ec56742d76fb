import pytest

from demandloom.plans.run import run_forecast
from demandloom.sources.tpch_retail import retail_tables

from conftest import SMALL


def test_whole_run(spark, tmp_path):
    result = run_forecast(retail_tables(spark, SMALL), str(tmp_path), year=1997,
                          model_type="random_forest", cv_folds=2, n_estimators=2, reports=True, digits=6)
    summary = result.summary.first()
    forecast = result.forecast.toPandas()
    assert summary["total_units"] == forecast["quantidade"].sum()
    assert summary["stores"] == forecast["pdv"].nunique()
    assert set(forecast["semana"]) == {1, 2, 3, 4, 5}
    for name in ("transactions_processed", "pdvs_processed", "products_processed", "feature_data",
                 "reports/sales_trend", "reports/categoria_distribution",
                 "reports/categoria_pdv_distribution", "reports/seasonal_pattern",
                 "reports/feature_importance"):
        assert (tmp_path / f"{name}.parquet" / "_SUCCESS").exists(), name
    (saved,) = (tmp_path / "models").iterdir()
    assert saved.name.startswith("random_forest_sales_forecast_")
    assert result.model_path.endswith(saved.name)
    assert result.reports["feature_importance"].count() == 20
    assert sum(r["total"] for r in result.reports["sales_trend"].collect()) == pytest.approx(
        spark.read.parquet(f"{tmp_path}/transactions_processed.parquet")
        .groupBy().sum("quantity").first()[0])
