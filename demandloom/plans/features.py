"""From cleaned sales to the weekly feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cyclical
from ..functions.calendar import CYCLES
from ..operators.categories import apply_categories, fit_categories
from ..operators.clean import add_ratios, fill_ratios
from ..operators.weekly import (attach_attributes, lag_expressions, rolling_expressions,
                                weekly_rollup)
from ..sources.staging import stage
from ..spec import CATEGORIES, LAGS, WEEKLY, WINDOWS, SeriesSpec


def weekly_series(sales: DataFrame, stores: DataFrame, products: DataFrame,
                  spec: SeriesSpec = WEEKLY, lags=LAGS, windows=WINDOWS,
                  include_current: bool = True, digits: int | None = None) -> DataFrame:
    """Weekly sums with attributes, raw ratios, lags and rolling statistics.

    Two shuffles: partial sums by series and week, then weekly rows by series. All lags and windows
    share the one sort of the second.
    """
    weekly = attach_attributes(weekly_rollup(sales, spec, digits=digits), stores, products)
    return add_ratios(weekly).withColumns({
        **lag_expressions(spec, lags),
        **rolling_expressions(spec, windows, include_current),
    })


def create_features(sales: DataFrame, stores: DataFrame, products: DataFrame,
                    spec: SeriesSpec = WEEKLY, lags=LAGS, windows=WINDOWS,
                    include_current: bool = True, digits: int | None = None,
                    dictionary: DataFrame | None = None) -> DataFrame:
    """The weekly feature table.

    The series are written to the shared folder once; the medians and the category dictionary read only
    their own columns of it, and everything after that is a projection with small joins. Pass the
    ``dictionary`` of an earlier run to code new data the same way.
    """
    series = stage(weekly_series(sales, stores, products, spec, lags, windows, include_current,
                                 digits), "weekly-series")
    fitted_here = dictionary is None
    if fitted_here:
        dictionary = fit_categories(series, CATEGORIES)
    coded = apply_categories(fill_ratios(series), dictionary, CATEGORIES,
                             replace_unseen=not fitted_here)
    sine, cosine = cyclical(F.col("week"), CYCLES["week"])
    return coded.withColumns({"week_sin": sine, "week_cos": cosine})
