import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandloom.operators import clean

SCHEMA = ("transaction_date timestamp_ntz, reference_date timestamp_ntz, internal_store_id long, "
          "internal_product_id long, quantity double, gross_value double, net_value double, "
          "gross_profit double, discount double, taxes double")
D = dt.datetime


def sale(date, quantity, gross=10.0, profit=2.0, discount=1.0, store=1, product=1):
    return (date, date, store, product, quantity, gross, gross, profit, discount, 0.5)


def dates(spark, *values):
    return spark.createDataFrame([(D(*v) if v else None,) for v in values],
                                 "transaction_date timestamp_ntz")


def test_calendar_at_year_edges(spark):
    df = dates(spark, (2022, 1, 1), (2022, 1, 2), (2022, 12, 31), (2020, 12, 31), (1999, 1, 3), None)
    found = [tuple(r) for r in clean.add_calendar(df).select(
        "year", "week", "dayofweek", "is_weekend").collect()]
    assert found == [(2022, 52, 5, 1), (2022, 52, 6, 1), (2022, 52, 5, 1), (2020, 53, 3, 0),
                     (1999, 53, 6, 1), (None, None, None, 0)]


def test_iso_week_year(spark):
    df = dates(spark, (2022, 1, 1), (2022, 1, 3), (1999, 1, 3), (2024, 12, 30))
    found = [tuple(r) for r in clean.add_calendar(df, week_year="iso").select(
        "year", "week").collect()]
    assert found == [(2021, 52), (2022, 1), (1998, 53), (2025, 1)]
    with pytest.raises(ValueError, match="week_year"):
        clean.add_calendar(df, week_year="fiscal")


def test_time_features(spark):
    row = clean.create_time_features(dates(spark, (2024, 2, 29))).first()
    assert (row["is_month_start"], row["is_month_end"], row["quarter"]) == (0, 1, 1)
    assert row["month_sin"] == pytest.approx(math.sin(2 * math.pi * 2 / 12))
    assert row["day_cos"] == pytest.approx(math.cos(2 * math.pi * 29 / 31))
    assert row["dayofweek_sin"] == pytest.approx(math.sin(2 * math.pi * 3 / 7))
    assert row["week_cos"] == pytest.approx(math.cos(2 * math.pi * 9 / 52))


def test_month_end_ignores_the_time_of_day(spark):
    row = clean.create_time_features(dates(spark, (2024, 2, 29, 13, 5))).first()
    assert row["is_month_end"] == 1


def test_text_dates(spark):
    df = spark.createDataFrame([("2022-03-04", "2022-03-01")],
                               "transaction_date string, reference_date string")
    parsed = clean.parse_dates(df)
    assert dict(parsed.dtypes)["transaction_date"] == "timestamp_ntz"
    assert parsed.first()["transaction_date"] == D(2022, 3, 4)
    bad = spark.createDataFrame([("not a date", "2022-03-01")],
                                "transaction_date string, reference_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE|cannot be"):
        clean.parse_dates(bad).collect()
    assert clean.parse_dates(bad, lenient=True).first()["transaction_date"] is None


def test_text_dates_with_a_pattern(spark):
    df = spark.createDataFrame([("04/03/2022",)], "transaction_date string")
    for lenient in (False, True):
        parsed = clean.parse_dates(df, lenient=lenient, pattern="dd/MM/yyyy")
        assert parsed.first()["transaction_date"] == D(2022, 3, 4)


def test_year_filter_drops_null_dates(spark):
    df = dates(spark, (2021, 12, 31, 23, 59), (2022, 1, 1), (2022, 12, 31, 23, 59), (2023, 1, 1),
               None)
    assert clean.filter_year(df, 2022).count() == 2


def test_return_flag(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,), (float("nan"),)],
                               "quantity double")
    assert [r[0] for r in clean.flag_returns(df).select("is_return").collect()] == [1, 0, 0, 0, 0]


def test_trim_keeps_values_on_the_bounds(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "quantity double")
    kept = clean.trim_outliers(df, low=0.1, high=0.9)
    assert sorted(r[0] for r in kept.collect()) == [float(v) for v in range(1, 10)]


def test_trim_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "quantity double")
    assert clean.trim_outliers(df).count() == 0


def test_ratios_with_zero_and_infinite_parts(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(0.0, 10.0, 1.0, 1.0), (2.0, 0.0, 1.0, 1.0), (2.0, inf, 1.0, 1.0), (2.0, 8.0, 4.0, 2.0),
         (4.0, 8.0, 2.0, None)],
        "quantity double, gross_value double, gross_profit double, discount double")
    found = [tuple(r)[4:] for r in clean.fill_ratios(clean.add_ratios(df)).collect()]
    # Prices 0, 2, 4 and margins 0, 0.1, 0.25, 0.5 exist; the missing ones take their medians.
    assert found == [(2.0, 0.1, 0.1), (0.0, 0.175, 0.0), (2.0, 0.0, 0.0), (4.0, 0.5, 0.25),
                     (2.0, 0.25, 0.0)]


def test_all_missing_median_leaves_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], "quantity double, gross_value double, "
                               "gross_profit double, discount double")
    row = clean.fill_ratios(clean.add_ratios(df)).first()
    assert (row["unit_price"], row["profit_margin"], row["discount_ratio"]) == (None, None, 0.0)


def test_nonfinite_becomes_null_in_floats_only(spark):
    df = spark.createDataFrame([(float("nan"), float("-inf"), 3, "x")],
                               "a double, b float, c int, d string")
    assert tuple(clean.drop_nonfinite(df).first()) == (None, None, 3, "x")


def test_preprocess_transactions(spark):
    inside = [sale(D(2022, 5, d), float(d)) for d in range(1, 11)]
    outside = [sale(D(2021, 5, 1), 5.0), sale(None, 5.0), sale(D(2022, 6, 1), None)]
    df = spark.createDataFrame(inside + outside, SCHEMA)
    made = clean.preprocess_transactions(df)
    # With ten values the outermost quantiles lie strictly inside the range.
    assert sorted(r["quantity"] for r in made.collect()) == [float(d) for d in range(2, 10)]
    assert {"year", "month", "week", "day", "dayofweek", "is_weekend", "is_return", "unit_price",
            "profit_margin", "discount_ratio"} <= set(made.columns)
    assert made.filter("unit_price is null").count() == 0


def test_stores(spark):
    df = spark.createDataFrame([(1, "On Premise"), (2, "Off Premise"), (3, None)],
                               "pdv long, premise string")
    made = clean.preprocess_pdv(df)
    assert made.columns == ["pdv", "premise_type", "is_on_premise"]
    assert [r["is_on_premise"] for r in made.orderBy("pdv").collect()] == [1, 0, 0]
    without = spark.createDataFrame([(1,)], "pdv long")
    assert clean.preprocess_pdv(without).columns == ["pdv"]


def test_products(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", 2.0)],
                               "produto long, categoria string, size double")
    assert [tuple(r) for r in clean.preprocess_products(df).orderBy("produto").collect()] == [
        (1, "Unknown", None), (2, "a", 2.0)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "a", None)],
                               "a int, b string, c double")
    assert {r["column_name"]: r["missing"] for r in clean.null_profile(df).collect()} == {
        "a": 0, "b": 1, "c": 2}


def test_model_columns(spark):
    df = spark.createDataFrame([], "quantity double, year int, marca string, descricao string, "
                               "categoria string, categoria_encoded int, reference_date date")
    assert clean.model_columns(df) == ["year", "categoria"]
    assert clean.numeric_columns(df) == ["quantity", "year", "categoria_encoded"]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "sales")
    spark.createDataFrame([sale(D(2022, 5, d), float(d)) for d in range(1, 11)], SCHEMA) \
        .write.parquet(path)
    df = clean.select_sales(spark.read.parquet(path)).groupBy("week").agg(F.sum("quantity"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(transaction_date,2022-01-01T00:00)" in plan
    assert "GreaterThanOrEqual(quantity," in plan
    assert "ReadSchema: struct<transaction_date:timestamp_ntz,quantity:double>" in plan
