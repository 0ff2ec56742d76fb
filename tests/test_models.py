import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from demandloom.models import (feature_importance, generate_forecast, initialize_model, load_model,
                               save_model, train, train_model)
from demandloom.models.matrix import add_codes, plan_matrix
from demandloom.models.train import measured_trees, prepare_training_data, side_by_side
from demandloom.operators.clean import (numeric_columns, preprocess_pdv, preprocess_products,
                                        select_sales)
from demandloom.operators.distribution import correlation_matrix
from demandloom.plans.features import create_features, weekly_series
from demandloom.sources import stage
from demandloom.sources.tpch_retail import retail_tables
from demandloom.spec import PRODUCT, STORE, SeriesSpec

from conftest import ROOT, SMALL


@pytest.fixture(scope="module")
def features(spark):
    tables = retail_tables(spark, SMALL)
    return stage(create_features(select_sales(tables.transactions, 1997),
                                 preprocess_pdv(tables.stores),
                                 preprocess_products(tables.products)), "features")


@pytest.fixture(scope="module")
def trained(features):
    return train_model(features, model_type="lightgbm", cv=2, n_estimators=2)


def test_model_types(spark):
    boosted = initialize_model("lightgbm")
    assert isinstance(boosted, GBTRegressor) and boosted.getMaxIter() == 1000
    assert (boosted.getStepSize(), boosted.getSeed()) == (0.05, 42)
    assert initialize_model("xgboost").getMaxDepth() == 7
    assert initialize_model("catboost", 3).getMaxIter() == 3
    forest = initialize_model("random_forest")
    assert isinstance(forest, RandomForestRegressor) and forest.getNumTrees() == 500
    assert (forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (12, 2)
    with pytest.raises(ValueError, match="unsupported model type"):
        initialize_model("linear")


def test_training_result(trained):
    assert [r["fold"] for r in trained.fold_metrics.orderBy("fold").collect()] == [0, 1]
    summary = trained.cv_summary.first()
    maes = [r["mae"] for r in trained.fold_metrics.collect()]
    assert summary["mae"] == pytest.approx(np.mean(maes))
    assert summary["mae_std"] == pytest.approx(np.std(maes))
    assert trained.test_metrics.first()["rmse"] > 0


@pytest.mark.parametrize("kind", ["lightgbm", "random_forest"])
def test_fits_at_the_same_time_equal_fits_in_turn(spark, features, kind):
    made = [train_model(features, model_type=kind, cv=3, n_estimators=2, at_once=n) for n in (1, 5)]
    first, second = ([r.asDict() for r in t.fold_metrics.orderBy("fold").collect()]
                     + [t.test_metrics.first().asDict()] for t in made)
    assert first == second
    assert (made[0].model.pipeline.stages[-1].toDebugString.split("\n")[1:]
            == made[1].model.pipeline.stages[-1].toDebugString.split("\n")[1:])
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()


def test_results_come_in_the_order_of_the_jobs(spark):
    assert side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(6)], 3) == list(range(6))

    def fails():
        raise ValueError("this one")
    with pytest.raises(ValueError, match="this one"):
        side_by_side(spark, [fails, lambda: 1], 2)


@pytest.mark.parametrize("kind", ["lightgbm", "random_forest"])
def test_trees_are_counted_by_their_error(spark, features, kind):
    rows = prepare_training_data(features).rows
    known, valid = rows.filter("ordinal <= 500"), rows.filter("ordinal > 500")
    options = {"stepSize": 0.5} if kind == "lightgbm" else {}
    trees, curve = measured_trees(initialize_model(kind, 16, **options), known, valid, 0.05)
    assert 1 <= trees <= 16 and curve[trees - 1] <= curve[0]
    model = initialize_model(kind, trees, **options).fit(known)
    errors = [(r["label"] - r["prediction"]) ** 2 for r in model.transform(valid).collect()]
    if kind == "random_forest":  # the curve is that of the first trees
        assert len(curve) == 16
        whole = initialize_model(kind, 16).fit(known).transform(valid).collect()
        errors = [(r["label"] - r["prediction"]) ** 2 for r in whole]
    assert curve[-1 if kind == "random_forest" else trees - 1] == pytest.approx(np.mean(errors))
    none, _ = measured_trees(initialize_model(kind, 16, **options), known, valid, 0.99)
    assert none == 1


def test_matrix_is_chronological(spark, features):
    matrix = prepare_training_data(features)
    assert matrix.total == features.count()
    made = [r["label"] for r in matrix.rows.orderBy("ordinal").collect()]
    expected = [r["quantity"] for r in features.orderBy("year", "week", STORE, PRODUCT).collect()]
    assert made == expected
    excluded = {"quantity", "marca", "fabricante"}
    assert not excluded & set(matrix.plan.plain + matrix.plan.nullable + matrix.plan.coded)
    assert not [c for c in matrix.plan.inputs if "encoded" in c]
    strict = plan_matrix(features, strict_features=True)
    assert "gross_value" in matrix.plan.plain and "gross_value" not in strict.inputs


def test_partitions_of_a_large_matrix_hold_more_rows(features, monkeypatch):
    """The driver hears from every partition at every level of a tree, so their number stays small."""
    assert [train.matrix_parts(n) for n in (0, 1, 25_000, 25_001, 600_000)] == [1, 1, 1, 2, 24]
    assert [train.matrix_parts(n) for n in (1_600_000, 36_000_000, 216_000_000)] == [64, 72, 432]
    monkeypatch.setattr(train, "MATRIX_ROWS", 2)
    rows = prepare_training_data(features).rows
    assert rows.count() == features.count() > 2 * train.MATRIX_PARTS
    assert rows.rdd.getNumPartitions() == train.MATRIX_PARTS


def test_gaps_and_categories_of_any_size(spark):
    """Five thousand labels reach the model as five thousand codes."""
    df = spark.createDataFrame(
        [(i % 40, float(i), None if i % 2 else float(i), f"c{i % 3}", f"id{i:05d}") for i in range(5000)],
        "year int, quantity double, gap double, small string, large string")
    spec = SeriesSpec(("large",), ("year",))
    matrix = prepare_training_data(df, spec=spec)
    assert (matrix.plan.nullable, matrix.plan.coded) == (["gap"], ["small", "large"])
    assert matrix.plan.inputs == ["year", "gap_filled", "gap_missing", "small_code", "large_code"]
    vectors = {tuple(r["features"].toArray()) for r in matrix.rows.collect()}
    assert {v[4] for v in vectors} == set(map(float, range(5000)))
    labels = {r["label"]: r["features"].toArray() for r in matrix.rows.collect()}
    for i in (0, 1, 17, 4999):
        expected = (i % 40, -1.0 if i % 2 else i, float(i % 2), i % 3, i)
        assert tuple(labels[float(i)]) == expected
    unseen = spark.createDataFrame([(1, None, "new", None)], "year int, gap double, small string, large string")
    coded = add_codes(unseen, matrix.dictionary, ["small", "large"]).first()
    assert (coded["small_code"], coded["large_code"], coded["small"]) == (-1, -1, "new")


MODEL_SCRIPT = """
import sys
from demandloom.models import generate_forecast, train_model
from demandloom.operators.clean import preprocess_pdv, preprocess_products, select_sales
from demandloom.plans.features import create_features
from demandloom.session import local_session
from demandloom.sources import drop_staged, stage
from demandloom.sources.tpch_retail import retail_tables
from pyspark.sql import functions as F

cores, shuffles, folder = sys.argv[1:]
spark = local_session(cores, int(shuffles), folder=folder)
tables = retail_tables(spark, "/root/testdata/sf0.001")
features = stage(create_features(select_sales(tables.transactions, None), preprocess_pdv(tables.stores),
                                 preprocess_products(tables.products), digits=6), "features")
import demandloom.models.train as train
train.MATRIX_ROWS = 700
trained = train_model(features, cv=2, n_estimators=3, stored=True)
rows = generate_forecast(trained.model, features)
print("DIGEST", rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.count("*")).first())
drop_staged(spark)
"""


def test_forecast_does_not_depend_on_the_machine(tmp_path):
    found = set()
    for cores, shuffles in (("2", "8"), ("4", "32"), ("8", "8")):
        made = subprocess.run(
            [sys.executable, "-c", MODEL_SCRIPT, cores, shuffles, str(tmp_path / cores)], cwd=ROOT,
            env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=600)
        found |= {line for line in made.stdout.splitlines() if line.startswith("DIGEST")}
        assert made.returncode == 0, made.stderr[-2000:]
    assert len(found) == 1


def test_forecast_covers_every_series_and_step(features, trained):
    made = generate_forecast(trained.model, features, 5)
    rows = made.collect()
    pairs = {tuple(r) for r in features.select(STORE, PRODUCT).distinct().collect()}
    assert len(rows) == 5 * len(pairs)
    assert {(r["pdv"], r["produto"], r["semana"]) for r in rows} == {
        (*p, i) for p in pairs for i in range(1, 6)}
    assert all(r["quantidade"] >= 0 for r in rows)
    assert dict(made.dtypes)["quantidade"] == "bigint"


def test_importance_names_every_input(trained):
    rows = feature_importance(trained.model).collect()
    assert {r["feature"] for r in rows} == set(trained.inputs)
    weights = [r["importance"] for r in rows]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1.0)


def test_saved_model_scores_the_same(features, trained, tmp_path):
    loaded = load_model(features.sparkSession, save_model(trained.model, str(tmp_path / "model")))
    first, second = (sorted(map(tuple, generate_forecast(m, features, 2).collect()))
                     for m in (trained.model, loaded))
    assert first == second


def test_correlation_of_all_features_equals_pandas(features):
    made = correlation_matrix(features).collect()
    numbers = features.select(numeric_columns(features)).toPandas()
    expected = numbers.corr().fillna(0.0)
    assert len(made) == len(expected) * (len(expected) - 1) // 2
    for r in made:
        known = expected.loc[r["col_a"], r["col_b"]]
        if abs(abs(known) - 0.1) > 1e-6:
            assert r["r"] == pytest.approx(known if abs(known) >= 0.1 else 0.0, abs=1e-6)


def test_weekly_series_shares_one_sort(spark):
    tables = retail_tables(spark, SMALL)
    plan = weekly_series(tables.transactions.selectExpr(
        "*", "year(transaction_date) as year", "weekofyear(transaction_date) as week",
        "0 as is_weekend"), preprocess_pdv(tables.stores), preprocess_products(tables.products)
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning(internal_store_id") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_folds_of_a_large_matrix_ask_few_partitions(features, monkeypatch):
    """Fits and measures of folds read the same few partitions, and count the same rows."""
    monkeypatch.setattr(train, "MATRIX_ROWS", 2)
    monkeypatch.setattr(train, "MATRIX_PARTS", 3)
    asked = []
    kept = train._fold_job
    monkeypatch.setattr(train, "_fold_job", lambda estimator, rows, fold: (
        asked.append(rows.rdd.getNumPartitions()), kept(estimator, rows, fold))[1])
    made = train_model(features, model_type="random_forest", cv=2, n_estimators=1, stored=True)
    assert asked == [3, 3]
    known = int(features.count() * 0.8)
    assert [r["n"] for r in made.fold_metrics.orderBy("fold").collect()] == [known // 3] * 2
