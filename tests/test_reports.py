import datetime as dt

import pandas as pd
import pytest

from demandloom.operators import reports

D = dt.date


def sales(spark, *rows):
    return spark.createDataFrame(
        [(dt.datetime(*d) if d else None, v) for d, v in rows],
        "transaction_date timestamp_ntz, quantity double")


def pairs(df):
    return [tuple(r) for r in df.orderBy("period").collect()]


def test_weekly_trend_fills_gaps(spark):
    df = sales(spark, ((2022, 1, 2), 1.0), ((2022, 1, 23), 2.0), ((2022, 1, 17), 3.0), (None, 9.0))
    assert pairs(reports.sales_trend(df)) == [
        (D(2022, 1, 2), 1.0), (D(2022, 1, 9), 0.0), (D(2022, 1, 16), 0.0), (D(2022, 1, 23), 5.0)]


@pytest.mark.parametrize("freq, rule", [("D", "D"), ("W", "W"), ("M", "ME")])
def test_trend_equals_pandas(spark, freq, rule):
    rows = [((2021, 11, 30, 23), 1.0), ((2021, 12, 31), 2.0), ((2022, 3, 1, 5), 4.0),
            ((2022, 3, 1, 9), None), ((2022, 5, 31), 8.0)]
    expected = pd.DataFrame({"d": [pd.Timestamp(*d) for d, _ in rows], "v": [v for _, v in rows]}) \
        .groupby(pd.Grouper(key="d", freq=rule))["v"].sum()
    assert pairs(reports.sales_trend(sales(spark, *rows), freq=freq)) == [
        (d.date(), v) for d, v in expected.items()]


def test_trend_of_one_date_and_bad_frequency(spark):
    assert pairs(reports.sales_trend(sales(spark, ((2022, 1, 31), 1.0)), freq="M")) == [
        (D(2022, 1, 31), 1.0)]
    with pytest.raises(ValueError, match="freq"):
        reports.sales_trend(sales(spark), freq="Y")


def test_top_categories(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", 3.0), ("c", 3.0), (None, 99.0), ("d", None)], "c string, quantity double")
    found = [tuple(r) for r in reports.category_distribution(df, "c", top_n=3).collect()]
    assert found == [("b", 3.0), ("c", 3.0), ("a", 1.0)]
    listed = spark.createDataFrame([("a",), ("never sold",), (None,)], "c string")
    found = reports.category_distribution(df, "c", dimension=listed).collect()
    assert [tuple(r) for r in found][-2:] == [("d", 0.0), ("never sold", 0.0)]


def test_seasonal_patterns_are_row_means_in_calendar_order(spark):
    df = sales(spark, ((2022, 1, 9), 4.0), ((2022, 1, 3), 1.0), ((2022, 1, 3), 2.0),
               ((2022, 2, 1), 6.0), (None, 5.0))
    daily = [tuple(r) for r in reports.seasonal_pattern(df, period="daily").collect()]
    assert daily == [(0, "Monday", 1.5), (1, "Tuesday", 6.0), (6, "Sunday", 4.0)]
    weekly = [tuple(r) for r in reports.seasonal_pattern(df).collect()]
    assert weekly == [(1, 1, pytest.approx(7 / 3)), (5, 5, 6.0)]
    monthly = [tuple(r) for r in reports.seasonal_pattern(df, period="monthly").collect()]
    assert [m[1] for m in monthly] == ["January", "February"]
    with pytest.raises(ValueError, match="period"):
        reports.seasonal_pattern(df, period="yearly")


def test_forecast_against_actual(spark):
    actual = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)],
                                   "week int, g string, quantity double")
    forecast = spark.createDataFrame([(2, "a", 4.0), (3, "a", 5.0)],
                                     "week int, g string, quantity double")
    found = reports.forecast_vs_actual(actual, forecast).orderBy("week").collect()
    assert [tuple(r) for r in found] == [(1, 3.0, None), (2, 3.0, 4.0), (3, None, 5.0)]
    grouped = reports.forecast_vs_actual(actual, forecast, groupby="g")
    long = reports.forecast_vs_actual_long(grouped).orderBy("week", "g", "kind").collect()
    assert [tuple(r) for r in long] == [
        (1, "a", "actual", 1.0), (1, "b", "actual", 2.0), (2, "a", "actual", 3.0),
        (2, "a", "forecast", 4.0), (3, "a", "forecast", 5.0)]


def test_top_features(spark):
    df = spark.createDataFrame([("b", 0.3), ("a", 0.3), ("c", 0.4)],
                               "feature string, importance double")
    assert [r["feature"] for r in reports.top_features(df, 2).collect()] == ["c", "a"]
