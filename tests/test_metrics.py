import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from demandloom.functions import nonnegative_units
from demandloom.operators import metrics
from pyspark.sql import functions as F


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "quantity double, prediction double")


def test_equals_the_spark_evaluator(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, [(float(a), float(a + b)) for a, b in rng.normal(size=(200, 2))])
    row = metrics.regression_metrics(df).first()
    for name in ("mae", "mse", "rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="quantity", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(df))


def test_zero_actuals_and_missing_pairs(spark):
    row = metrics.regression_metrics(
        frame(spark, [(0.0, 5.0), (2.0, 1.0), (4.0, None), (None, 1.0)])).first()
    assert (row["n"], row["mape"]) == (2, 0.5)


def test_constant_actuals(spark):
    assert metrics.regression_metrics(frame(spark, [(1.0, 1.0), (1.0, 1.0)])).first()["r2"] == 1.0
    assert metrics.regression_metrics(frame(spark, [(1.0, 2.0), (1.0, 1.0)])).first()["r2"] == 0.0


def test_fold_summary(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 6.0)], "mae double, rmse double")
    assert tuple(metrics.fold_summary(df).first()) == (2.0, 4.0, 1.0, 2.0)


def test_units_round_half_to_even_and_never_below_zero(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -0.4, -3.0)], "p double")
    made = df.select(nonnegative_units(F.col("p"))).collect()
    assert [r[0] for r in made] == [0, 2, 2, 0, 0]


def test_run_summary(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 7)], "pdv long, produto long, quantidade long")
    assert tuple(metrics.forecast_summary(df).first()) == (12, 1, 2)
