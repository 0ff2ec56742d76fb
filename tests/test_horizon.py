import math

import pytest

from demandloom.operators import horizon
from demandloom.spec import PRODUCT, STORE

LAGS = (1, 2, 3, 4, 8, 12)
SCHEMA = (f"{STORE} long, {PRODUCT} long, year int, week int, quantity double, "
          "quantity_roll_mean_4 double, " + ", ".join(f"quantity_lag_{k} double" for k in LAGS))


def weekly(spark, *keys):
    rows = [(s, p, y, w, q, 7.0, *[100.0 * q + k for k in LAGS]) for s, p, y, w, q in keys]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("last, expected", [
    (46, [(2022, 47), (2022, 48), (2022, 49), (2022, 50), (2022, 51)]),
    (48, [(2022, 49), (2022, 50), (2022, 51), (2022, 52), (2023, 1)]),
    (50, [(2022, 51), (2022, 52), (2023, 1), (2023, 2), (2023, 3)]),
    (52, [(2023, 1), (2023, 2), (2023, 3), (2023, 4), (2023, 5)]),
    (53, [(2023, 2), (2023, 3), (2023, 4), (2023, 5), (2023, 6)]),
])
def test_weeks_after_the_last(spark, last, expected):
    made = horizon.generate_forecast_features(weekly(spark, (1, 1, 2022, last, 1.0)))
    found = made.orderBy("semana").collect()
    assert [(r["year"], r["week"]) for r in found] == expected
    assert [r["semana"] for r in found] == [1, 2, 3, 4, 5]
    assert found[0]["week_sin"] == pytest.approx(math.sin(2 * math.pi * expected[0][1] / 52))


def test_lags_and_carried_features(spark):
    made = horizon.generate_forecast_features(
        weekly(spark, (1, 1, 2022, 10, 3.0), (1, 1, 2022, 12, 5.0), (2, 1, 2022, 4, 9.0)), 4)
    found = {(r[STORE], r["semana"]): r for r in made.collect()}
    assert len(found) == 8
    # A series that stopped earlier still continues after the last week of the whole frame.
    assert [found[2, i]["week"] for i in range(1, 5)] == [13, 14, 15, 16]
    for store, q in ((1, 5.0), (2, 9.0)):
        for i in range(1, 5):
            row = found[store, i]
            for k in LAGS:
                expected = q if k == 1 or i >= k else 100.0 * q + k
                assert row[f"quantity_lag_{k}"] == expected
            assert (row["quantity"], row["quantity_roll_mean_4"]) == (q, 7.0)


def test_only_present_lags_are_touched(spark):
    df = weekly(spark, (1, 1, 2022, 10, 3.0)).drop("quantity_lag_8", "quantity_lag_12")
    made = horizon.generate_forecast_features(df)
    assert "quantity_lag_8" not in made.columns


def test_prepare_drops_what_a_model_must_not_see(spark):
    made = horizon.generate_forecast_features(weekly(spark, (1, 1, 2022, 10, 3.0)))
    assert not {"quantity", "semana"} & set(horizon.prepare_forecast_features(made).columns)
    kept = horizon.prepare_forecast_features(made, ["week"]).columns
    assert "quantity" in kept and "week" not in kept
