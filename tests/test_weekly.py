import datetime as dt

import numpy as np
import pandas as pd
import pytest

from demandloom.operators import star, weekly
from demandloom.operators.blocks import over_long_series
from demandloom.operators.weekly import lag_expressions, rolling_expressions
from demandloom.spec import PRODUCT, STORE, SeriesSpec

WEEK = f"{STORE} long, {PRODUCT} long, year int, week int, quantity double"
PAIR = [STORE, PRODUCT]


def series(spark, weeks):
    return spark.createDataFrame(
        [(1, 1, y, w, q) for (y, w, q) in weeks], WEEK)


def test_rollup_sums_and_null_keys(spark):
    schema = (f"{STORE} long, {PRODUCT} long, year int, week int, is_weekend int, quantity double, "
              "gross_value double, net_value double, gross_profit double, discount double, "
              "taxes double")
    nan = float("nan")
    rows = [
        (1, 1, 2022, 5, 1, 2.0, None, 1.0, 1.0, nan, 1.0),
        (1, 1, 2022, 5, 0, -2.0, None, 1.0, 1.0, 3.0, 1.0),
        (None, 1, 2022, 5, 0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (1, None, 2022, 5, 0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (1, 1, None, 5, 0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0),
    ]
    found = weekly.weekly_rollup(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in found] == [(1, 1, 2022, 5, 0.0, 0.0, 2.0, 2.0, 3.0, 2.0, 0.5)]


def test_rounded_sums_do_not_depend_on_order(spark):
    schema = (f"{STORE} long, {PRODUCT} long, year int, week int, is_weekend int, quantity double")
    rows = [(1, 1, 2022, 5, 0, v) for v in (0.1, 0.2, 0.3)]
    made = weekly.weekly_rollup(spark.createDataFrame(rows, schema), measures=("quantity",),
                                digits=6)
    assert made.first()["quantity"] == 0.6


def test_lags_are_positional(spark):
    df = series(spark, [(2022, 1, 1.0), (2022, 5, 2.0), (2022, 52, 3.0), (2023, 1, 4.0)])
    made = weekly.create_lag_features(df, PAIR, lags=[1, 3], order_by=("year", "week"))
    assert [tuple(r)[4:] for r in made.orderBy("year", "week").collect()] == [
        (1.0, None, None), (2.0, 1.0, None), (3.0, 2.0, None), (4.0, 3.0, 1.0)]


def test_default_order_is_the_transaction_date(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2022, 1, d), float(d)) for d in (3, 1, 2)] + [("a", None, 9.0)],
        "k string, transaction_date date, quantity double")
    made = weekly.create_lag_features(df, ["k"], lags=[1])
    assert {r["quantity"]: r["quantity_lag_1"] for r in made.collect()} == {
        1.0: None, 2.0: 1.0, 3.0: 2.0, 9.0: 3.0}


def test_keys_with_underscores_do_not_collide(spark):
    df = spark.createDataFrame([("a_b", "c", 1, 1.0), ("a", "b_c", 2, 2.0)],
                               "s string, p string, t int, quantity double")
    made = weekly.create_lag_features(df, ["s", "p"], lags=[1], order_by=("t",))
    assert [r["quantity_lag_1"] for r in made.collect()] == [None, None]


@pytest.mark.parametrize("length", [1, 2, 13, 40])
def test_rolling_equals_pandas(spark, length):
    rng = np.random.default_rng(length)
    values = [None if rng.random() < 0.2 else float(rng.integers(-9, 9)) for _ in range(length)]
    df = series(spark, [(2022, i + 1, v) for i, v in enumerate(values)])
    made = weekly.create_rolling_features(df, PAIR, order_by=("year", "week")) \
        .orderBy("week").toPandas()
    x = pd.Series(values, dtype="float64")
    for w in (2, 4, 8, 12):
        rolled = x.rolling(w, min_periods=1)
        for name in ("mean", "std", "min", "max"):
            expected = getattr(rolled, name)().fillna(0)
            assert np.allclose(made[f"quantity_roll_{name}_{w}"], expected, atol=1e-9)


def test_rolling_before_the_current_row(spark):
    df = series(spark, [(2022, 1, 1.0), (2022, 2, 5.0), (2022, 3, 9.0)])
    made = weekly.create_rolling_features(df, PAIR, windows=[2], order_by=("year", "week"),
                                          include_current=False).orderBy("week")
    assert [r["quantity_roll_mean_2"] for r in made.collect()] == [0.0, 1.0, 3.0]


def test_rolling_fills_columns_already_there(spark):
    df = spark.createDataFrame([("a", 1, 2.0, None)],
                               "k string, t int, quantity double, other_roll_max double")
    row = weekly.create_rolling_features(df, ["k"], windows=[2], order_by=("t",)).first()
    assert row["other_roll_max"] == 0.0


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "midnight"])
def test_blocks_equal_plain_windows(spark, kind):
    """Tiny blocks, one hot series, null keys, null dates and repeated minutes."""
    rng = np.random.default_rng(3)
    start = dt.datetime(2022, 1, 1)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 else (None if i % 2 else f"k{i % 7}")
        at = None if i % 50 == 0 else start + dt.timedelta(seconds=int(rng.integers(0, 200_000)))
        rows.append((i, key, at, float(rng.integers(0, 100))))
    df = spark.createDataFrame(rows, "id int, k string, at timestamp_ntz, quantity double")
    if kind == "midnight":
        df = df.withColumn("at", df["at"].cast("date").cast("timestamp_ntz"))
    else:
        df = df.withColumn("at", df["at"].cast(kind))
    spec = SeriesSpec(("k",), ("at", "id"))

    def columns(window=None):
        return {**lag_expressions(spec, [1, 5], window),
                **rolling_expressions(spec, [3, 12], True, window)}

    plain = df.withColumns(columns())
    spread = over_long_series(df, spec.keys, spec.order_by, columns, back=12, block=13)
    a = plain.orderBy("id").toPandas()
    b = spread.select(plain.columns).orderBy("id").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_long_series_through_the_public_functions(spark, rows):
    df = spark.createDataFrame([("a", y, w, float(y + w)) for y in (1, 2) for w in range(5)],
                               "k string, year int, week int, quantity double")
    for function, option in ((weekly.create_lag_features, {"lags": [1, 2]}),
                             (weekly.create_rolling_features, {"windows": [3]})):
        plain = function(df, ["k"], order_by=("year", "week"), **option)
        spread = function(df, ["k"], order_by=("year", "week"), long_series=True, **option)
        assert rows(plain) == rows(spread, *plain.columns)
    daily = df.selectExpr("k", "date_add(date '2022-01-01', 9 * year + week) as transaction_date",
                          "quantity")
    plain = weekly.create_lag_features(daily, ["k"])
    spread = weekly.create_lag_features(daily, ["k"], long_series=True)
    assert rows(plain) == rows(spread, *plain.columns)


def test_last_observation_looks_at_the_year_first(spark):
    df = series(spark, [(2022, 52, 1.0), (2023, 2, 2.0), (2023, 1, 3.0)])
    assert [r["quantity"] for r in weekly.last_observation(df).collect()] == [2.0]


def test_distinct_series(spark):
    df = series(spark, [(2022, 52, 1.0), (2023, 2, 2.0)])
    assert weekly.distinct_series(df).count() == 1


FACTS = f"{STORE} long, {PRODUCT} long, quantity double, label string"


def dims(spark, store_keys=(1, 2)):
    stores = spark.createDataFrame([(k, f"s{k}") for k in store_keys], "pdv long, name string")
    products = spark.createDataFrame([(1, "p1")], "produto long, label string")
    return stores, products


def test_merge_keeps_orphans_and_renames_clashes(spark):
    facts = spark.createDataFrame([(1, 1, 1.0, "x"), (9, 1, 2.0, "y"), (None, 1, 3.0, "z")], FACTS)
    merged = star.merge_datasets(facts, *dims(spark))
    assert {"label_x", "label_y"} <= set(merged.columns)
    assert {r["quantity"]: r["name"] for r in merged.collect()} == {1.0: "s1", 2.0: None, 3.0: None}
    assert star.merge_datasets(facts, *dims(spark), how="inner").count() == 1


def test_repeated_dimension_keys(spark):
    facts = spark.createDataFrame([(1, 1, 1.0, "x")], FACTS)
    stores, products = dims(spark, (1, 1))
    with pytest.raises(ValueError, match="not unique"):
        star.merge_datasets(facts, stores, products)
    assert star.merge_datasets(facts, stores, products, allow_repeated_keys=True).count() == 2
    with pytest.raises(ValueError, match="how"):
        star.attach(facts, stores, STORE, "pdv", "cross")
