"""Cleaning of transactions, stores and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar_columns, finite, safe_ratio, time_feature_columns
from ..sources.staging import stage
from ..spec import UNKNOWN
from .quantiles import approximate_quantiles, exact_medians, exact_quantiles

# The quantity range that is kept.
TRIM_LOW, TRIM_HIGH = 0.001, 0.999


def parse_dates(df: DataFrame, columns=("transaction_date", "reference_date"),
                lenient: bool = False, pattern: str | None = None) -> DataFrame:
    """Text dates become timestamps; typed ones are left alone so scans can still push filters.

    ISO text is expected unless a ``pattern`` is given. Text that is no date raises, or becomes null when
    ``lenient``.
    """
    types = dict(df.dtypes)
    for name in columns:
        if types.get(name) == "string":
            df = df.withColumn(name, _timestamp(F.col(name), lenient, pattern))
    return df


def _timestamp(text: Column, lenient: bool, pattern: str | None) -> Column:
    if pattern is None:
        return text.try_cast("timestamp_ntz") if lenient else text.cast("timestamp_ntz")
    if lenient:
        return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit(pattern))


def add_calendar(df: DataFrame, date_col: str = "transaction_date",
                 week_year: str = "calendar") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date_col), week_year))


def create_time_features(df: DataFrame, date_col: str = "transaction_date",
                         week_year: str = "calendar") -> DataFrame:
    """Calendar parts, month boundaries, quarter and cyclical encodings of a date column."""
    df = parse_dates(df, (date_col,))
    return df.withColumns(time_feature_columns(F.col(date_col), week_year))


def filter_year(df: DataFrame, year: int, date_col: str = "transaction_date") -> DataFrame:
    """Rows of one calendar year, as a date range that reaches the Parquet scan."""
    kind = df.schema[date_col].dataType
    start, end = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (year, year + 1))
    return df.filter((F.col(date_col) >= start) & (F.col(date_col) < end))


def flag_returns(df: DataFrame) -> DataFrame:
    """``is_return`` is 1 for negative quantities; the rows are kept."""
    negative = (finite(F.col("quantity").cast("double")) < 0).cast("int")
    return df.withColumn("is_return", F.coalesce(negative, F.lit(0)))


def trim_outliers(df: DataFrame, column: str = "quantity", low: float = TRIM_LOW,
                  high: float = TRIM_HIGH, approximate: bool = False,
                  bounds: tuple[float | None, float | None] | None = None) -> DataFrame:
    """Keep rows between two quantiles of ``column``, bounds included; nulls are dropped.

    The bounds are worked out first and enter the plan as literals, so they are pushed to the scan. Give
    them as ``bounds`` if they are known, as from stored sketches.
    """
    find = approximate_quantiles if approximate else exact_quantiles
    lower, upper = find(df, {column: [low, high]})[column] if bounds is None else bounds
    if lower is None:
        return df.filter(F.lit(False))
    value = F.col(column)
    return df.filter((value >= F.lit(lower)) & (value <= F.lit(upper)))


def add_ratios(df: DataFrame) -> DataFrame:
    """Unit price, profit margin and discount ratio; a zero denominator gives a missing value."""
    return df.withColumns({
        "unit_price": safe_ratio(F.col("gross_value"), F.col("quantity")),
        "profit_margin": safe_ratio(F.col("gross_profit"), F.col("gross_value")),
        "discount_ratio": safe_ratio(F.col("discount"), F.col("gross_value")),
    })


def drop_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating-point column."""
    floating = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: finite(F.col(name)) for name in floating})


def fill_ratios(df: DataFrame, medians: dict[str, float | None] | None = None) -> DataFrame:
    """Missing prices and margins take the median over the whole frame, missing discounts take 0."""
    if medians is None:
        medians = exact_medians(df, ["unit_price", "profit_margin"])
    filled = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items() if m is not None}
    filled["discount_ratio"] = F.coalesce(F.col("discount_ratio"), F.lit(0.0))
    return df.withColumns(filled)


def select_sales(df: DataFrame, year: int | None = 2022, week_year: str = "calendar",
                 approximate_trim: bool = False) -> DataFrame:
    """The row-selecting part of the cleaning: dates, calendar, year, return flag, trim."""
    df = parse_dates(df)
    if year is not None:
        df = filter_year(df, year)
    df = trim_outliers(df, approximate=approximate_trim)
    return flag_returns(add_calendar(drop_nonfinite(df), week_year=week_year))


def preprocess_transactions(df: DataFrame, year: int | None = 2022, week_year: str = "calendar",
                            approximate_trim: bool = False) -> DataFrame:
    """Cleaned transactions of one year with calendar columns, return flag and filled ratios.

    The facts are scanned three times: twice for the trim bounds, once to write the rows that are kept;
    the medians read only their two columns of these.
    """
    sales = select_sales(df, year, week_year, approximate_trim)
    return fill_ratios(stage(add_ratios(sales), "clean-transactions"))


def preprocess_pdv(df: DataFrame) -> DataFrame:
    """Stores with ``premise`` named ``premise_type`` and an on-premise flag."""
    df = df.withColumnRenamed("premise", "premise_type")
    if "premise_type" in df.columns:
        on_premise = (F.col("premise_type") == "On Premise").cast("int")
        df = df.withColumn("is_on_premise", F.coalesce(on_premise, F.lit(0)))
    return df


def preprocess_products(df: DataFrame) -> DataFrame:
    """Products with missing text replaced by a placeholder; other types are untouched."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(UNKNOWN, subset=text) if text else df


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values, from a single pass."""
    counts = []
    for field in df.schema.fields:
        missing = F.col(field.name).isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(field.name)
        counts.append(F.count_if(missing).alias(field.name))
    return df.agg(*counts).unpivot([], df.columns, "column_name", "missing")


def model_columns(df: DataFrame, target: str = "quantity") -> list[str]:
    """Feature columns for a model: no target, dates, category codes or free-text labels."""
    dropped = {target, "transaction_date", "reference_date", "marca", "fabricante", "descricao"}
    return [c for c in df.columns if c not in dropped and not c.endswith("_encoded")]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def drop_missing_target(df: DataFrame, target: str = "quantity") -> DataFrame:
    return df.filter(F.col(target).isNotNull())
