import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandloom.operators import quantiles as q

PROBABILITIES = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]


def check(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = q.exact_quantiles(df, {"x": PROBABILITIES}, **options)["x"]
    assert found == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12, abs=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_equals_numpy(spark, values):
    check(spark, values)


def test_brackets_and_narrowing(spark):
    """Small limits force every path that a large column would take."""
    rng = np.random.default_rng(7)
    values = [float(v) for v in rng.normal(size=20_000)]
    check(spark, values)
    check(spark, values, accuracy=50, ordered_values=200)


def test_coarse_sketch_still_gives_the_exact_answer(spark):
    rng = np.random.default_rng(8)
    check(spark, [float(v) for v in rng.exponential(size=5_000)], accuracy=5, ordered_values=50)


def test_hot_value(spark):
    rng = np.random.default_rng(9)
    values = [1.0] * 4_000 + [float(v) for v in rng.uniform(0, 2, size=8_000)]
    check(spark, values, accuracy=100, ordered_values=100)


def test_missing_values_are_ignored(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)],
                               "a double, b double")
    assert q.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}
    assert q.exact_medians(df, ["a"]) == {"a": 2.0}


def test_approximate(spark):
    df = spark.range(1, 1001).selectExpr("double(id) as x")
    low, high = q.approximate_quantiles(df, {"x": [0.1, 0.9]})["x"]
    assert abs(low - 100) <= 1 and abs(high - 900) <= 1


def by_week(spark, values, weeks):
    rows = [(2020 + i % weeks // 10, i % weeks % 10, v, None if i % 3 else v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "year int, week int, x double, `some` double")


@pytest.mark.parametrize("k", [8, 200, q.SKETCH_K])
def test_sketches_of_weeks_give_exact_quantiles_of_any_range(spark, tmp_path, k):
    rng = np.random.default_rng(10)
    values = [float(v) for v in rng.exponential(size=6_000)] + [1.0] * 3_000 + [None, float("nan")]
    df = by_week(spark, values, 40)
    # Stored and read back, as weeks are.
    q.quantile_sketches(df, ["x", "some"], k=k).write.partitionBy("year", "week").parquet(f"{tmp_path}/s")
    sketches = spark.read.parquet(f"{tmp_path}/s")
    wanted = {"x": PROBABILITIES, "some": [0.1, 0.5]}
    for where in (None, F.col("year") == 2021, (F.col("year") * 100 + F.col("week")).between(202005, 202301)):
        rows = df if where is None else df.filter(where)
        assert q.quantiles_from_sketches(df, sketches, wanted, where, k) == q.exact_quantiles(rows, wanted)
    assert q.quantiles_from_sketches(df, sketches, wanted, k=k, ordered_values=50) == q.exact_quantiles(df, wanted)


def test_one_scan_of_the_rows(spark, tmp_path, monkeypatch):
    df = by_week(spark, [float(v) for v in range(5_000)], 20)
    sketches, passes, select = q.quantile_sketches(df, ["x"]), [], q._select
    monkeypatch.setattr(q, "_select", lambda *a: passes.append("select") or select(*a))
    monkeypatch.setattr(q, "_narrow", lambda v, targets, *a: passes.extend(targets))
    monkeypatch.setattr(q, "_bracket_all", lambda *a: passes.append("bracket"))
    assert q.quantiles_from_sketches(df, sketches, {"x": [0.0, 0.5, 1.0]}) == {"x": [0.0, 2499.5, 4999.0]}
    assert passes == ["select"]


def test_sketches_of_nothing_and_of_other_rows(spark):
    df = by_week(spark, [1.0, 2.0, None, float("inf")], 4)
    sketches = q.quantile_sketches(df, ["x", "some"])
    assert q.quantiles_from_sketches(df, sketches, {"x": [0.5]}, F.lit(False)) == {"x": [None]}
    assert q.quantiles_from_sketches(df, sketches, {"x": [0.5]}) == {"x": [1.5]}
    nothing = df.limit(0)
    assert q.quantiles_from_sketches(nothing, q.quantile_sketches(nothing, ["x"]), {"x": [0.5]}) == {"x": [None]}
    for other in (df.filter("x = 1"), df.unionAll(df), nothing):
        with pytest.raises(ValueError):
            q.quantiles_from_sketches(other, sketches, {"x": [0.5]})
