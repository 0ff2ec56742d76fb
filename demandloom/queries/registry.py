"""Registered queries: each takes ``(spark, folder)`` and returns a DataFrame.

Floating results are rounded to what their exact value carries, so that the order of summation does
not show; dates are returned as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nonnegative_units
from ..models.predict import generate_forecast
from ..models.train import (LABEL, PREDICTION, feature_importance, load_model, prepare_training_data,
                            save_model, train_model)
from ..operators import categories, clean, decompose, distinct, distribution, horizon, metrics
from ..operators import quantiles as q
from ..operators import reports, splits, star, weekly
from ..operators.ordinal import ORDINAL, TOTAL, weekly_ordinal
from ..plans import incremental
from ..plans.features import create_features
from ..sources import (application_folder, conform, load_tables, stage, write_features, write_forecast_csv,
                       write_processed)
from ..sources.series_store import newest_week, open_store, replace_years, write_store
from ..sources.tables import PRODUCTS, STORES, TRANSACTIONS
from ..sources.tpch_retail import _table, products, retail_tables, stores, transactions
from ..spec import LAGS, MEASURES, PRODUCT, STORE, WINDOWS, SeriesSpec

YEAR = 1997
# No measure of the retail tables carries more decimals, so weekly sums rounded to them are exact.
DIGITS = 6
PAIR = [STORE, PRODUCT]
GRAIN = [*PAIR, "year", "week"]
ORDER = ("year", "week")
RATIOS = ["unit_price", "profit_margin", "discount_ratio"]
# The trained queries measure how many trees are worth fitting (README), up to these numbers: a booster stops
# when a tree lowers the squared error by less than the tolerance. Their step is six times that of a run, which
# reaches the same error with a sixth of the trees.
BOOSTED, FOREST, TOLERANCE, STEP, FOLDS = 100, 16, 0.02, 0.3, 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded but the ratios: quotients of equal numbers are equal as they are."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    # Adding zero turns a negative zero into a plain one.
    return df.withColumns({
        c: (F.col(c) if c in RATIOS else F.round(c, digits)) + F.lit(0.0) for c in names})


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def sales_all_years(spark, folder) -> DataFrame:
    return clean.add_calendar(transactions(spark, folder))


def weekly_all_years(spark, folder) -> DataFrame:
    return weekly.weekly_rollup(sales_all_years(spark, folder), digits=DIGITS)


def staged_lags(spark, folder) -> DataFrame:
    return stage(weekly_with_lags(spark, folder), "lags")


def weekly_with_lags(spark, folder) -> DataFrame:
    return weekly.create_lag_features(weekly_all_years(spark, folder), PAIR, lags=LAGS,
                                      order_by=ORDER)


def weekly_series(spark, folder) -> DataFrame:
    return weekly.create_rolling_features(weekly_with_lags(spark, folder), PAIR,
                                          windows=WINDOWS, order_by=ORDER)


def _results_folder(spark) -> str:
    return f"{application_folder(spark)}/results-{uuid.uuid4().hex}"


def features(spark, folder) -> DataFrame:
    """The flagship: all cleaned sales to weekly features."""
    tables = retail_tables(spark, folder)
    return create_features(
        clean.select_sales(tables.transactions, None),
        clean.preprocess_pdv(tables.stores), clean.preprocess_products(tables.products),
        digits=DIGITS)


# Scans and profiles

@query
def scan_profile(spark, folder):
    return clean.null_profile(transactions(spark, folder))


@query
def lag_null_profile(spark, folder):
    return clean.null_profile(weekly_with_lags(spark, folder))


# Dates and calendar

@query
def date_parse(spark, folder):
    text = _table(spark, folder, "lineitem").select(
        "l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("transaction_date"))
    parsed = clean.parse_dates(text)
    date = F.col("transaction_date")
    return parsed.select("l_orderkey", F.year(date).alias("year"), F.month(date).alias("month"),
                         F.dayofmonth(date).alias("day"))


@query
def calendar(spark, folder):
    items = _table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    return clean.create_time_features(items, "l_shipdate").select(
        "l_orderkey", day("l_shipdate"), "year", "month", "week", "day", "dayofweek",
        "is_weekend", "is_month_start", "is_month_end", "quarter")


@query
def calendar_iso_year(spark, folder):
    items = _table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    return clean.add_calendar(items, "l_shipdate", week_year="iso").select(
        "l_orderkey", day("l_shipdate"), "year", "week")


@query
def cyclical(spark, folder):
    items = _table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    made = clean.create_time_features(items, "l_shipdate")
    return rounded(made.select("l_orderkey", day("l_shipdate"),
                               *[c for c in made.columns if c.endswith(("_sin", "_cos"))]), 9)


# Cleaning

@query
def year_filter(spark, folder):
    return clean.filter_year(transactions(spark, folder), YEAR).select(
        *PAIR, day("transaction_date"), "quantity")


@query
def return_flag(spark, folder):
    return clean.flag_returns(transactions(spark, folder)).select(*PAIR, "quantity", "is_return")


@query
def quantiles(spark, folder):
    wanted = {"quantity": [0.001, 0.5, 0.999], "gross_value": [0.001, 0.25, 0.5, 0.999],
              "gross_profit": [0.1, 0.5, 0.9]}
    found = q.exact_quantiles(transactions(spark, folder), wanted)
    rows = [(c, p, v) for c, ps in wanted.items() for p, v in zip(ps, found[c], strict=True)]
    return rounded(spark.createDataFrame(
        rows, "column_name string, probability double, value double"))


@query
def quantiles_by_sketch(spark, folder):
    """Quantiles of several sets of years from one table of weekly sketches."""
    wanted = {"quantity": [0.001, 0.5, 0.999], "gross_profit": [0.1, 0.5, 0.9]}
    sales = sales_all_years(spark, folder)
    sketches = stage(q.quantile_sketches(sales, wanted), "week-sketches")
    rows = []
    for years, where in (("all", F.col("year").isNotNull()), ("one", F.col("year") == YEAR),
                         ("outer", F.abs(F.col("year") - YEAR) > 1)):
        found = q.quantiles_from_sketches(sales, sketches, wanted, where)
        rows += [(years, c, p, v) for c, ps in wanted.items() for p, v in zip(ps, found[c], strict=True)]
    return rounded(spark.createDataFrame(
        rows, "years string, column_name string, probability double, value double"))


@query
def trim_by_sketch(spark, folder):
    """One year's sales between bounds that come from weekly sketches."""
    sales, year = sales_all_years(spark, folder), F.col("year") == YEAR
    sketches = stage(q.quantile_sketches(sales, ["quantity"]), "week-sketches")
    found = q.quantiles_from_sketches(sales, sketches, {"quantity": [0.05, 0.95]}, year)["quantity"]
    trimmed = clean.trim_outliers(sales.filter(year), bounds=tuple(found))
    return rounded(trimmed.select(*PAIR, "quantity", "gross_value"))


@query
def outlier_trim(spark, folder):
    """Bounds that bite: the default ones lie at the ends of the given quantities."""
    trimmed = clean.trim_outliers(transactions(spark, folder), low=0.05, high=0.95)
    return rounded(trimmed.select(*PAIR, "quantity", "gross_value"))


@query
def outlier_trim_value(spark, folder):
    trimmed = clean.trim_outliers(transactions(spark, folder), "gross_value", 0.01, 0.99)
    return rounded(trimmed.select(*PAIR, "quantity", "gross_value"))


@query
def ratios(spark, folder):
    made = clean.drop_nonfinite(clean.add_ratios(weekly_all_years(spark, folder)))
    return rounded(made.select(*GRAIN, *RATIOS))


@query
def ratios_filled(spark, folder):
    made = clean.add_ratios(weekly_all_years(spark, folder))
    return rounded(clean.fill_ratios(stage(made, "weekly-ratios")).select(*GRAIN, *RATIOS))


@query
def clean_transactions(spark, folder):
    made = clean.preprocess_transactions(transactions(spark, folder), YEAR)
    return rounded(made.withColumns({c: day(c) for c in ("transaction_date", "reference_date")}))


@query
def processed_tables(spark, folder):
    """The cleaned transactions, written as a partitioned table and read back."""
    tables = retail_tables(spark, folder)
    root = _results_folder(spark)
    write_processed(root, clean.preprocess_transactions(tables.transactions, YEAR),
                    clean.preprocess_pdv(tables.stores), clean.preprocess_products(tables.products))
    made = spark.read.parquet(f"{root}/transactions_processed.parquet")
    return rounded(made.withColumns({c: day(c) for c in ("transaction_date", "reference_date")}))


@query
def store_clean(spark, folder):
    return clean.preprocess_pdv(stores(spark, folder))


@query
def product_clean(spark, folder):
    return clean.preprocess_products(products(spark, folder))


def dirty_transactions(spark, folder) -> DataFrame:
    """The given sales with missing keys, dates and values, values that are no numbers, and orphans."""
    sales = transactions(spark, folder)
    size = F.abs("quantity")

    def spoilt(column, case, value):
        return F.when(size == case, value).otherwise(F.col(column)).alias(column)

    nothing = F.lit(None)
    return sales.select(
        F.when(size == 7, nothing).otherwise(F.date_format("transaction_date", "yyyy-MM-dd")).alias("transaction_date"),
        "reference_date",
        F.when(size == 3, nothing).when(size == 4, F.col(STORE) + 1000).otherwise(F.col(STORE)).cast("int").alias(STORE),
        spoilt(PRODUCT, 9, nothing),
        F.when(size == 8, nothing).when(size == 12, float("nan")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(size == 11, 0.0).when(size == 6, float("inf")).otherwise(F.col("gross_value")).alias("gross_value"),
        "net_value", spoilt("gross_profit", 13, F.lit(float("-inf"))), spoilt("discount", 10, nothing),
        spoilt("taxes", 5, F.lit(float("nan"))))


def dirty_dimensions(spark, folder) -> tuple[DataFrame, DataFrame]:
    shops, goods = stores(spark, folder), products(spark, folder)
    shops = shops.withColumn("premise", F.when(F.col("pdv") % 5 != 0, F.col("premise")))
    goods = goods.withColumns({c: F.when(F.col("produto") % 4 != 0, F.col(c)) for c in ("categoria", "marca")})
    return conform(shops, STORES, "stores"), conform(goods, PRODUCTS, "products")


@query
def dirty_clean(spark, folder):
    """Spoilt sales through the whole cleaning, joined to spoilt dimensions and coded with known brands."""
    sales = conform(dirty_transactions(spark, folder), TRANSACTIONS, "transactions")
    shops, goods = dirty_dimensions(spark, folder)
    goods = clean.preprocess_products(goods)
    merged = star.merge_datasets(
        clean.preprocess_transactions(sales, None), clean.preprocess_pdv(shops), goods)
    known = categories.fit_categories(goods.filter("produto <= 15"), ["marca"])
    coded = categories.apply_categories(merged, known, ["marca"])
    return rounded(coded.select(
        *PAIR, day("transaction_date"), "year", "week", "is_return", "quantity", "gross_value", "gross_profit",
        "discount", "taxes", *RATIOS, "pdv", "premise_type", "is_on_premise", "categoria", "marca",
        "marca_encoded"))


@query
def dirty_weekly(spark, folder):
    """Rows without a key are left out, values that are no numbers count as missing."""
    sales = clean.parse_dates(conform(dirty_transactions(spark, folder), TRANSACTIONS, "transactions"))
    return rounded(weekly.weekly_rollup(clean.add_calendar(sales), digits=DIGITS))


@query
def loaded_tables(spark, folder):
    """The three input tables written as Parquet, loaded with their checked schemas and rolled up."""
    root = _results_folder(spark)
    for name, table in zip(("sales", "stores", "products"), retail_tables(spark, folder), strict=True):
        table.write.parquet(f"{root}/{name}")
    tables = load_tables(spark, *(f"{root}/{name}" for name in ("sales", "stores", "products")))
    rolled = weekly.weekly_rollup(clean.add_calendar(tables.transactions), digits=DIGITS)
    return rounded(weekly.attach_attributes(
        rolled, clean.preprocess_pdv(tables.stores), clean.preprocess_products(tables.products)
    ).select(*GRAIN, *MEASURES, "premise_type", "categoria"))


# Joins

def _joined(spark, folder, how):
    tables = retail_tables(spark, folder)
    merged = star.merge_datasets(
        tables.transactions, clean.preprocess_pdv(tables.stores),
        clean.preprocess_products(tables.products), how)
    return rounded(merged.select(
        day("transaction_date"), *PAIR, "quantity", "gross_value", "pdv", "premise_type",
        "categoria_pdv", "zipcode", "produto", "categoria", "marca", "fabricante"))


@query
def star_join(spark, folder):
    return _joined(spark, folder, "left")


@query
def star_join_inner(spark, folder):
    return _joined(spark, folder, "inner")


# Weekly series

@query
def weekly_rollup(spark, folder):
    return rounded(weekly_all_years(spark, folder))


@query
def weekly_lags_and_ratios(spark, folder):
    """Weekly sums with two lags and the ratios."""
    made = clean.add_ratios(weekly_all_years(spark, folder))
    return rounded(weekly.create_lag_features(made, PAIR, lags=(1, 12), order_by=ORDER))


@query
def weekly_rollup_iso_year(spark, folder):
    sales = clean.add_calendar(transactions(spark, folder), week_year="iso")
    return rounded(weekly.weekly_rollup(sales, digits=DIGITS))


@query
def weekly_attributes(spark, folder):
    tables = retail_tables(spark, folder)
    return weekly.attach_attributes(
        weekly_all_years(spark, folder), clean.preprocess_pdv(tables.stores),
        clean.preprocess_products(tables.products)).drop(*MEASURES, "is_weekend")


@query
def lags(spark, folder):
    return weekly_with_lags(spark, folder).select(
        *GRAIN, "quantity", *[f"quantity_lag_{k}" for k in LAGS])


@query
def rolling(spark, folder):
    made = weekly.create_rolling_features(weekly_all_years(spark, folder), PAIR, order_by=ORDER)
    return rounded(made.select(*GRAIN, *[c for c in made.columns if "_roll_" in c]))


@query
def rolling_before(spark, folder):
    made = weekly.create_rolling_features(weekly_all_years(spark, folder), PAIR, order_by=ORDER,
                                          include_current=False)
    return rounded(made.select(*GRAIN, *[c for c in made.columns if "_roll_" in c]))


def _sparse_weekly(spark, folder):
    """Supplier by part: very many series of very few weeks."""
    sales = clean.add_calendar(transactions(spark, folder, grain="sparse"))
    return weekly.weekly_rollup(sales, digits=DIGITS)


@query
def weekly_rollup_sparse(spark, folder):
    return rounded(_sparse_weekly(spark, folder))


@query
def rolling_sparse(spark, folder):
    lagged = weekly.create_lag_features(_sparse_weekly(spark, folder), PAIR, order_by=ORDER)
    made = weekly.create_rolling_features(lagged, PAIR, order_by=ORDER)
    return rounded(made.select(*GRAIN, "quantity", *[f"quantity_lag_{k}" for k in (1, 2, 3, 4)],
                               *[c for c in made.columns if "_roll_" in c]))


@query
def lags_long_series(spark, folder):
    """A few event types hold all rows, so each series is spread over many tasks."""
    events = _table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return weekly.create_lag_features(events, ["event_type"], "value", order_by=("ts", "event_id"),
                                      long_series=True).drop("ts")


@query
def rolling_long_series(spark, folder):
    items = _table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return rounded(weekly.create_rolling_features(
        items, ["event_type"], "value", order_by=("ts", "event_id"), long_series=True).drop("ts"))


# Half a year, a year of weeks and a year of days.
LONG_WINDOWS = (26, 52, 365)


@query
def rolling_year(spark, folder):
    """Long windows over a few event types that hold all rows; sums of hundredths are exact."""
    items = _table(spark, folder, "events").select(
        "event_id", "event_type", "ts", F.round(F.col("value") * 100).alias("value"))
    return rounded(weekly.create_rolling_features(
        items, ["event_type"], "value", LONG_WINDOWS, ("ts", "event_id"), long_series=True).drop("ts"))


@query
def rolling_year_before(spark, folder):
    """A year of earlier weeks for every pair."""
    made = weekly.create_rolling_features(
        weekly_all_years(spark, folder), PAIR, windows=(12, 52), order_by=ORDER, include_current=False)
    return rounded(made.select(*GRAIN, *[c for c in made.columns if "_roll_" in c]))


@query
def lags_text_ties(spark, folder):
    """Order keys of one priority and date, told apart by their text."""
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", F.col("o_orderkey").cast("string").alias("name"),
        "o_totalprice")
    return weekly.create_lag_features(
        orders, ["o_orderpriority"], "o_totalprice", lags=(1, 2), order_by=("o_orderdate", "name"),
        long_series=True).drop("o_orderdate", "name")


@query
def lags_by_date(spark, folder):
    """All lines of one flag in the order of their dates, ties told apart by every key there is."""
    items = _table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").alias("transaction_date"), "l_orderkey", "l_linenumber", "l_partkey",
        "l_suppkey", "l_quantity", "l_extendedprice")
    ties = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return weekly.create_lag_features(
        items, ["l_returnflag"], "l_extendedprice", lags=(1, 3), order_by=("transaction_date", *ties),
        long_series=True).drop("transaction_date")


@query
def weekly_features(spark, folder):
    return rounded(features(spark, folder))


@query
def feature_table(spark, folder):
    """Written as a partitioned table and read back."""
    root = _results_folder(spark)
    write_features(features(spark, folder), root)
    return rounded(spark.read.parquet(f"{root}/feature_data.parquet"))


@query
def model_input(spark, folder):
    known = clean.drop_missing_target(features(spark, folder), "quantity_lag_4")
    return rounded(known.select(clean.model_columns(known)))


@query
def incremental_features(spark, folder):
    """All weeks in three runs: most years without some weeks, the later years, and the weeks that came late."""
    results = _results_folder(spark)
    write_processed(results, sales_all_years(spark, folder))
    sales = spark.read.parquet(f"{results}/transactions_processed.parquet")
    weeks = incremental.weeks_of(sales)
    late = [w for w in weeks if YEAR * 100 - 200 + 20 <= w < YEAR * 100 - 200 + 26]
    for run in ([w for w in weeks if w < YEAR * 100 and w not in late], [w for w in weeks if w >= YEAR * 100], late):
        incremental.update_weeks(sales, results, run, digits=DIGITS)
    made = incremental.read_features(spark, results)
    return rounded(made.select(*GRAIN, "quantity", *[c for c in made.columns if "_lag_" in c or "_roll_" in c]))


@query
def stored_lags(spark, folder):
    """Lags and windows on a store by series, one year of which was wrong at first and is replaced."""
    store, sold = f"{_results_folder(spark)}/weekly", stage(weekly_all_years(spark, folder), "weekly")
    wrong = F.when(F.col("year") == YEAR, -F.col("quantity")).otherwise(F.col("quantity"))
    write_store(sold.withColumn("quantity", wrong), store)
    replace_years(sold.filter(F.col("year") == YEAR), store)
    made = weekly.create_lag_features(open_store(spark, store), PAIR, lags=LAGS, order_by=ORDER)
    made = weekly.create_rolling_features(made, PAIR, windows=WINDOWS, order_by=ORDER)
    return rounded(made.select(*GRAIN, "quantity", *[c for c in made.columns if "_lag_" in c or "_roll_" in c]))


@query
def stored_horizon(spark, folder):
    """The horizon of a feature store by series: no row moves between the store and the result."""
    store = f"{_results_folder(spark)}/features"
    features = write_store(stage(weekly_series(spark, folder), "weekly-series"), store)
    return _horizon_columns(horizon.generate_forecast_features(features, newest=newest_week(spark, store)))


@query
def last_observation(spark, folder):
    return weekly.last_observation(weekly_all_years(spark, folder)).select(*GRAIN, "quantity")


@query
def distinct_series(spark, folder):
    return weekly.distinct_series(sales_all_years(spark, folder))


# Category codes

@query
def category_codes(spark, folder):
    parts = _table(spark, folder, "part")
    made, _ = categories.encode_categorical_features(
        parts.select("p_partkey", "p_brand", "p_type", "p_name"), ["p_brand", "p_type", "p_name"])
    return made


@query
def category_apply(spark, folder):
    """Customers of one year are the known categories; orders of all years are coded with them."""
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderpriority").alias("priority"))
    known = clean.filter_year(orders, YEAR, "o_orderdate")
    dictionary = categories.fit_categories(known, ["customer", "priority"])
    return categories.apply_categories(
        orders, dictionary, ["customer", "priority"]).drop("o_orderdate")


# Splits, folds and metrics

def numbered_weekly(spark, folder) -> DataFrame:
    return stage(weekly_ordinal(weekly_all_years(spark, folder)).drop(TOTAL), "weekly")


@query
def time_split(spark, folder):
    return splits.time_split(numbered_weekly(spark, folder)).select(*GRAIN, ORDINAL, "split")


@query
def time_split_numbered(spark, folder):
    return splits.time_split(weekly_all_years(spark, folder), numbered=True).select(*GRAIN, "ordinal", "split")


@query
def time_split_ties(spark, folder):
    """Many lines share a date and a flag; the cut takes some of them."""
    lines = _table(spark, folder, "lineitem").select("l_shipdate", "l_returnflag")
    made = splits.time_split(lines, 0.37, SeriesSpec(("l_returnflag",), ("l_shipdate",)))
    return made.groupBy(day("l_shipdate"), "l_returnflag", "split").agg(F.count("*").alias("lines"))


@query
def split_union(spark, folder):
    labelled = stage(splits.time_split(weekly_all_years(spark, folder), numbered=True), "split")
    train = labelled.filter("split = 'train'").drop("split")
    test = labelled.filter("split = 'test'").drop("split")
    return train.unionByName(test).select(*GRAIN, "ordinal", "quantity")


@query
def time_folds(spark, folder):
    return splits.time_folds(numbered_weekly(spark, folder)).select(*GRAIN, ORDINAL, "fold", "part")


@query
def time_folds_numbered(spark, folder):
    return splits.time_folds(weekly_all_years(spark, folder), numbered=True).select(
        *GRAIN, "ordinal", "fold", "part")


@query
def regression_metrics(spark, folder):
    return rounded(metrics.regression_metrics(
        weekly_with_lags(spark, folder), "quantity", "quantity_lag_1"))


@query
def regression_metrics_by_store(spark, folder):
    return rounded(metrics.regression_metrics(
        weekly_with_lags(spark, folder), "quantity", "quantity_lag_1", [STORE]))


@query
def fold_summary(spark, folder):
    tested = splits.time_folds(staged_lags(spark, folder)).filter("part = 'test'")
    per_fold = metrics.regression_metrics(tested, "quantity", "quantity_lag_1", ["fold"])
    return rounded(metrics.fold_summary(per_fold))


# Horizon and forecast

def _horizon_columns(made: DataFrame) -> DataFrame:
    return rounded(made.select(
        "semana", *GRAIN, "quantity", "week_sin", "week_cos",
        *[f"quantity_lag_{k}" for k in LAGS], "quantity_roll_mean_4", "quantity_roll_std_12"))


@query
def horizon_features(spark, folder):
    series = stage(weekly_series(spark, folder), "weekly-series")
    return _horizon_columns(horizon.generate_forecast_features(series))


def _rolling_mean_forecast(spark, folder):
    """A forecast without a model: the last rolling mean of every series."""
    series = stage(weekly_series(spark, folder), "weekly-series")
    made = horizon.generate_forecast_features(series)
    return made.select("semana", F.col(STORE).alias("pdv"), F.col(PRODUCT).alias("produto"),
                       nonnegative_units(F.col("quantity_roll_mean_4")).alias("quantidade"))


@query
def forecast_units(spark, folder):
    return _rolling_mean_forecast(spark, folder)


@query
def forecast_csv(spark, folder):
    path = write_forecast_csv(_rolling_mean_forecast(spark, folder), _results_folder(spark))
    return (spark.read.option("sep", ";").option("header", True)
            .schema("semana int, pdv long, produto long, quantidade long").csv(path))


@query
def run_summary(spark, folder):
    return metrics.forecast_summary(_rolling_mean_forecast(spark, folder))


@query
def distinct_by_sketch(spark, folder):
    """Stores and products per year, and whether merged weekly sketches come within 3 %."""
    sales = clean.add_calendar(transactions(spark, folder, "sparse")).filter("year is not null")
    sketches = stage(distinct.distinct_sketches(sales, PAIR), "week-sketches")
    found = distinct.estimated_distinct(sketches, PAIR, groupby=["year"]).toDF("year", "stores_found", "products_found")
    exact = sales.groupBy("year").agg(F.count_distinct(STORE).alias("stores"), F.count_distinct(PRODUCT).alias("products"))
    near = [F.abs(F.col(f"{c}_found") - F.col(c)) <= 0.03 * F.col(c) for c in ("stores", "products")]
    return exact.join(found, "year").select("year", "stores", "products", (near[0] & near[1]).alias("near"))


@query
def forecast_inputs(spark, folder):
    """What a model may see of the horizon."""
    series = stage(weekly_series(spark, folder), "weekly-series")
    seen = horizon.prepare_forecast_features(horizon.generate_forecast_features(series))
    return rounded(seen.select(*GRAIN, *[f"quantity_lag_{k}" for k in LAGS], "quantity_roll_mean_4",
                               "quantity_roll_std_12", "week_sin", "week_cos",
                               *[c for c in seen.columns if c in ("quantity", "semana")]))


def _trained(spark, folder, model_type, trees=None):
    """Trees by measured error, or a given number where only rows are counted."""
    known = stage(features(spark, folder), "features")
    forest = model_type == "random_forest"
    trained = train_model(
        known, model_type=model_type, cv=FOLDS, n_estimators=trees or (FOREST if forest else BOOSTED),
        tolerance=None if trees else TOLERANCE, stored=True, **({} if forest else {"stepSize": STEP}))
    return trained, known


@query
def forecast(spark, folder):
    trained, known = _trained(spark, folder, "lightgbm")
    return generate_forecast(trained.model, known)


@query
def forecast_forest(spark, folder):
    """The forest, saved and loaded before it scores."""
    trained, known = _trained(spark, folder, "random_forest")
    path = save_model(trained.model, f"{_results_folder(spark)}/model")
    return generate_forecast(load_model(spark, path), known)


@query
def training_metrics(spark, folder):
    trained, _ = _trained(spark, folder, "catboost")
    folds = trained.fold_metrics.withColumn("part", F.concat(F.lit("fold "), F.col("fold")))
    return folds.drop("fold").unionByName(
        trained.test_metrics.withColumn("part", F.lit("test")))


@query
def importance(spark, folder):
    trained, _ = _trained(spark, folder, "xgboost")
    return reports.top_features(feature_importance(trained.model))


@query
def forecast_coverage(spark, folder):
    """Every pair once per step, whole numbers, none negative."""
    trained, known = _trained(spark, folder, "xgboost", trees=1)
    return generate_forecast(trained.model, known).groupBy("semana").agg(
        F.count("*").alias("forecasts"), F.countDistinct("pdv", "produto").alias("pairs"),
        F.count_if(F.col("quantidade") < 0).alias("negative"))


@query
def model_roundtrip(spark, folder):
    """Rows in which a model that was saved and loaded scores differently."""
    trained, known = _trained(spark, folder, "lightgbm", trees=2)
    path = save_model(trained.model, f"{_results_folder(spark)}/model")
    made, again = (generate_forecast(m, known) for m in (trained.model, load_model(spark, path)))
    keys = ["semana", "pdv", "produto"]
    both = made.join(again.withColumnRenamed("quantidade", "loaded"), keys, "full")
    return both.agg(F.count("*").alias("forecasts"), F.count_if(
        ~F.col("quantidade").eqNullSafe(F.col("loaded"))).alias("differing"))


@query
def fold_sizes(spark, folder):
    """How many rows every fold and the test part are measured on."""
    trained, _ = _trained(spark, folder, "catboost", trees=1)
    folds = trained.fold_metrics.select(F.concat(F.lit("fold "), F.col("fold")).alias("part"), "n")
    return folds.unionByName(trained.test_metrics.select(F.lit("test").alias("part"), "n"))


@query
def importance_shape(spark, folder):
    """The name of every input, and what all importances add up to."""
    trained, _ = _trained(spark, folder, "random_forest", trees=2)
    made = feature_importance(trained.model)
    total = made.agg(F.round(F.sum("importance"), 6)).first()[0]
    return made.select("feature", F.lit(total).alias("total"))


@query
def model_exact(spark, folder):
    """One unsampled tree over six cells predicts the mean of each, for a booster and a forest."""
    items = _table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"), (F.col("l_linenumber") % 2).alias("odd"),
        F.col("l_quantity").alias("quantity"))
    rows = stage(items, "cells")
    spec = SeriesSpec(("odd",), ("flag",))
    made = None
    for kind, options in (("catboost", {}), ("random_forest", {"bootstrap": False})):
        trained = train_model(rows, model_type=kind, cv=FOLDS, n_estimators=1, spec=spec, stored=True, **options)
        scored = trained.model.transform(rows.select("flag", "odd").distinct()).select(
            F.lit(kind).alias("kind"), "flag", "odd", F.round(PREDICTION, 6).alias("prediction"))
        made = scored if made is None else made.unionByName(scored)
    return made


@query
def fold_metrics_exact(spark, folder):
    """The measures of every fold and of the test part, for one unsampled tree over six cells.

    Rows are ordered by what they hold, so tied rows are equal and every part is the same set in SQL.
    """
    items = _table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"), (F.col("l_linenumber") % 2).alias("odd"),
        F.col("l_quantity").alias("quantity"))
    trained = train_model(stage(items, "cells"), model_type="random_forest", cv=FOLDS, n_estimators=1,
                          spec=SeriesSpec(("flag", "odd"), ("quantity",)), stored=True, bootstrap=False)
    folds = trained.fold_metrics.withColumn("part", F.concat(F.lit("fold "), F.col("fold"))).drop("fold")
    return rounded(folds.unionByName(trained.test_metrics.withColumn("part", F.lit("test"))))


@query
def importance_exact(spark, folder):
    """Importances of one unsampled tree over two features of two values, for a booster and a forest.

    The feature that explains more is split first, and the other one gets what is left.
    """
    rows = stage(_table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("status"), (F.col("l_linenumber") % 2).alias("odd"),
        F.col("l_quantity").alias("quantity")), "cells")
    made = None
    for kind, options in (("catboost", {}), ("random_forest", {"bootstrap": False})):
        trained = train_model(rows, model_type=kind, cv=FOLDS, n_estimators=1, stored=True,
                              spec=SeriesSpec(("odd",), ("status",)), **options)
        weights = feature_importance(trained.model).withColumn("kind", F.lit(kind))
        made = weights if made is None else made.unionByName(weights)
    return rounded(made, 4)


@query
def model_matrix(spark, folder):
    """The vectors in chronological order, one column per input."""
    matrix = prepare_training_data(features(spark, folder))
    named = matrix.rows.select("ordinal", LABEL, vector_to_array("features").alias("values"))
    return rounded(named.select("ordinal", LABEL, *[
        F.col("values")[i].alias(name) for i, name in enumerate(matrix.plan.inputs)]))


# Reports

@query
def trend_daily(spark, folder):
    return rounded(reports.sales_trend(transactions(spark, folder), freq="D")).withColumn(
        "period", day("period"))


@query
def trend_weekly(spark, folder):
    return rounded(reports.sales_trend(transactions(spark, folder), freq="W")).withColumn(
        "period", day("period"))


@query
def trend_monthly(spark, folder):
    return rounded(reports.sales_trend(transactions(spark, folder), value_col="net_value",
                                       freq="M"), 4).withColumn("period", day("period"))


@query
def trend_event_days(spark, folder):
    events = _table(spark, folder, "events")
    return rounded(reports.sales_trend(events, "ts", "value", "D"), 4).withColumn(
        "period", day("period"))


@query
def top_categories(spark, folder):
    tables = retail_tables(spark, folder)
    goods = clean.preprocess_products(tables.products)
    joined = star.attach(tables.transactions, goods, PRODUCT, "produto", "inner")
    return rounded(reports.category_distribution(joined, "marca", dimension=goods))


@query
def top_store_categories(spark, folder):
    tables = retail_tables(spark, folder)
    shops = clean.preprocess_pdv(tables.stores)
    joined = star.attach(tables.transactions, shops, STORE, "pdv", "inner")
    return rounded(reports.category_distribution(joined, "categoria_pdv", "net_value",
                                                 dimension=shops), 4)


@query
def seasonality_weekday(spark, folder):
    return rounded(reports.seasonal_pattern(transactions(spark, folder), period="daily"))


@query
def seasonality_week(spark, folder):
    return rounded(reports.seasonal_pattern(transactions(spark, folder), period="weekly"))


@query
def seasonality_month(spark, folder):
    return rounded(reports.seasonal_pattern(transactions(spark, folder), period="monthly"))


@query
def forecast_vs_actual(spark, folder):
    return rounded(reports.forecast_vs_actual(
        weekly_all_years(spark, folder), weekly_with_lags(spark, folder), ORDER,
        forecast_value_col="quantity_lag_1"))


@query
def forecast_vs_actual_by_store(spark, folder):
    return rounded(reports.forecast_vs_actual_long(reports.forecast_vs_actual(
        weekly_all_years(spark, folder), weekly_with_lags(spark, folder), "week",
        groupby=STORE, forecast_value_col="quantity_lag_1")))


@query
def correlation(spark, folder):
    return rounded(distribution.correlation_matrix(
        _table(spark, folder, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], threshold=0.001), 8)


@query
def correlation_weekly(spark, folder):
    """Lags are null at the start of a series, so every pair has its own rows."""
    made = staged_lags(spark, folder)
    return rounded(distribution.correlation_matrix(
        made, [*MEASURES, "is_weekend", *[f"quantity_lag_{k}" for k in LAGS]]), 7)


@query
def correlation_features(spark, folder):
    """All numbers of the feature table."""
    known = stage(rounded(features(spark, folder)), "rounded-features")
    return rounded(distribution.correlation_matrix(known), 6)


@query
def error_histogram(spark, folder):
    made = distribution.error_histogram(
        staged_lags(spark, folder), "quantity", "quantity_lag_1")
    return rounded(made)


@query
def error_summary(spark, folder):
    return rounded(distribution.error_summary(
        staged_lags(spark, folder), "quantity", "quantity_lag_1"))


@query
def density(spark, folder):
    return rounded(distribution.error_density(
        staged_lags(spark, folder), "quantity", "quantity_lag_1"), 9)


@query
def density_binned(spark, folder):
    return rounded(distribution.error_density(
        staged_lags(spark, folder), "quantity", "quantity_lag_1",
        bins=512), 9)


def _decomposed(spark, folder, value_col, period, model, keys=()):
    made = decompose.decompose_time_series(
        transactions(spark, folder), value_col=value_col, period=period, model=model, keys=keys)
    return rounded(made.withColumn("transaction_date", day("transaction_date")))


@query
def decompose_additive(spark, folder):
    return _decomposed(spark, folder, "quantity", 52, "additive")


@query
def decompose_multiplicative(spark, folder):
    items = _table(spark, folder, "lineitem")
    made = decompose.decompose_time_series(items, "l_shipdate", "l_quantity", 7, "multiplicative")
    return rounded(made.withColumn("l_shipdate", day("l_shipdate")))


@query
def decompose_by_store(spark, folder):
    return _decomposed(spark, folder, "quantity", 7, "additive", (STORE,))


@query
def decompose_yearly(spark, folder):
    """Daily sales with a season of a year."""
    return _decomposed(spark, folder, "quantity", 365, "additive")


@query
def decompose_sparse(spark, folder):
    """Sales by part, of which many have too few dates."""
    made = decompose.decompose_time_series(
        transactions(spark, folder, grain="sparse"), period=14, keys=(PRODUCT,))
    return rounded(made.withColumn("transaction_date", day("transaction_date")))
