import math

import numpy as np
import pandas as pd
import pytest

from demandloom.operators import distribution as d


def frame(spark, errors):
    return spark.createDataFrame([(float(e), 0.0) for e in errors],
                                 "quantity double, prediction double")


@pytest.mark.parametrize("seed, bins", [(1, 30), (2, 7), (3, 30)])
def test_histogram_equals_numpy(spark, seed, bins):
    rng = np.random.default_rng(seed)
    errors = rng.integers(-100, 102, size=500).astype(float)
    errors = np.append(errors, [-100.0, 101.0])
    made = d.error_histogram(frame(spark, errors), bins=bins).orderBy("bin").toPandas()
    counts, edges = np.histogram(errors, bins=bins)
    assert list(made["count"]) == list(counts)
    assert np.allclose(made["left_edge"], edges[:-1]) and np.allclose(made["right_edge"], edges[1:])


def test_histogram_of_equal_errors(spark):
    made = d.error_histogram(frame(spark, [3.0, 3.0])).toPandas()
    assert made["count"].sum() == 2 and (made["count"] > 0).sum() == 1
    assert d.error_histogram(frame(spark, [])).count() == 0


def test_summary(spark):
    df = spark.createDataFrame([(5.0, 1.0), (2.0, 1.0), (1.0, None), (0.0, 1.0)],
                               "quantity double, prediction double")
    row = d.error_summary(df).first()
    assert (row["n"], row["mean_error"], row["median_error"]) == (3, pytest.approx(4 / 3), 1.0)


def density(errors, points):
    x = np.linspace(errors.min(), errors.max(), points)
    h = errors.std(ddof=1) * len(errors) ** -0.2
    z = (x[:, None] - errors[None, :]) / h
    return x, np.exp(-0.5 * z * z).sum(axis=1) / (len(errors) * h * math.sqrt(2 * math.pi))


def test_density_by_definition(spark):
    errors = np.round(np.random.default_rng(4).normal(size=300), 1)
    made = d.error_density(frame(spark, errors)).orderBy("point").toPandas()
    x, expected = density(errors, 200)
    assert np.allclose(made["x"], x) and np.allclose(made["density"], expected)
    binned = d.error_density(frame(spark, errors), bins=2000).orderBy("point").toPandas()
    assert np.allclose(binned["density"], expected, atol=2e-3)


def test_density_needs_spread(spark):
    assert d.error_density(frame(spark, [1.0, 1.0])).count() == 0
    assert d.error_density(frame(spark, [1.0])).count() == 0


def correlated(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=400)
    data = pd.DataFrame({"a": base, "b": base + rng.normal(size=400), "c": rng.normal(size=400),
                         "flat": 0.1, "big": 1e9 + base})
    data.loc[rng.random(400) < 0.2, "a"] = np.nan
    data.loc[rng.random(400) < 0.2, "b"] = np.nan
    rows = [tuple(None if v != v else float(v) for v in r) for r in data.itertuples(index=False)]
    return data, spark.createDataFrame(rows, "a double, b double, c double, flat double, big double")


def test_correlation_equals_pandas(spark):
    data, df = correlated(spark)
    expected = data.drop(columns="flat").corr()
    found = {(r["col_a"], r["col_b"]): r["r"] for r in
             d.correlation_matrix(df, threshold=0.0).collect()}
    assert len(found) == 10
    for (a, b), r in found.items():
        if "flat" in (a, b):
            assert r == 0.0
        else:
            assert r == pytest.approx(expected.loc[a, b], abs=1e-6)


def test_correlation_threshold(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, -1.0), (3.0, 6.0, 1.0),
                                (4.0, 8.0, -1.5)], "x double, y double, z double")
    weak = d.correlation_matrix(df, threshold=0.99).collect()
    assert {(r["col_a"], r["col_b"]): r["r"] for r in weak} == {
        ("y", "x"): pytest.approx(1.0), ("z", "x"): 0.0, ("z", "y"): 0.0}
    with pytest.raises(ValueError, match="two numeric"):
        d.correlation_matrix(df, ["x"])


@pytest.mark.parametrize("columns", [2, 6, 7, 40])
def test_correlation_does_not_depend_on_the_other_columns(spark, columns):
    """A pair whose common rows lie far from the rest of both columns."""
    rng = np.random.default_rng(6)
    data = pd.DataFrame(rng.normal(size=(400, columns)), columns=[f"c{i}" for i in range(columns)])
    data["c1"] = np.where(np.arange(400) % 4 == 0, rng.normal(size=400), np.nan)
    data["c0"] = np.where(np.arange(400) % 4 == 0, 1e8 + data["c1"], rng.normal(size=400))
    rows = [tuple(None if v != v else float(v) for v in r) for r in data.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data.columns)).repartition(5)
    found = {(r["col_a"], r["col_b"]): r["r"] for r in d.correlation_matrix(df, threshold=0.0).collect()}
    assert found["c1", "c0"] == pytest.approx(data["c0"].corr(data["c1"]), abs=1e-9)
    assert found["c1", "c0"] > 0.9999999


def test_correlation_of_columns_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0)], "x double, y double")
    assert d.correlation_matrix(df, threshold=0.0).collect() == [("y", "x", 0.0)]
    assert d.correlation_matrix(df.limit(0), threshold=0.0).collect() == [("y", "x", 0.0)]


def test_density_adds_cells_up_in_the_plan_of_spark(spark):
    made = d.error_density(frame(spark, [1.0, 2.0, 4.0]))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "mapInPandas" not in plan
    # Errors are added up by cell before they move.
    assert plan.index("Exchange hashpartitioning(cell") < plan.rindex("keys=[cell")
    assert "partial_sum" in plan[plan.index("Exchange hashpartitioning(cell"):]


@pytest.mark.parametrize("kind", ["tails", "offset", "clusters", "tiny", "two"])
def test_density_of_any_shape(spark, kind):
    rng = np.random.default_rng(6)
    errors = {"tails": rng.standard_cauchy(3000), "offset": 1e6 + rng.normal(size=2000),
              "clusters": np.concatenate([rng.normal(size=900), 500 + rng.normal(size=100), [-4000.0]]),
              "tiny": 1e-9 * rng.exponential(size=500), "two": np.array([0.0, 1.0])}[kind]
    made = d.error_density(frame(spark, errors)).orderBy("point").toPandas()
    x, expected = density(errors, 200)
    h = errors.std(ddof=1) * len(errors) ** -0.2
    assert list(made["point"]) == list(range(200)) and np.allclose(made["x"], x)
    # In units of one kernel per error.
    tolerance = 1e-7 if kind == "offset" else 1e-12  # numbers near 1e6 carry no more digits
    assert np.abs(made["density"] - expected).max() * h < tolerance
