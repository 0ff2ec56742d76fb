"""Feature rows for the weeks after the last observed one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cyclical
from ..functions.calendar import CYCLES
from ..spec import WEEKLY, SeriesSpec
from .weekly import last_observation

WEEKS_PER_YEAR = CYCLES["week"]
# Lags that are carried into the horizon.
HORIZON_LAGS = range(1, 13)


def generate_forecast_features(features: DataFrame, forecast_weeks: int = 5,
                               spec: SeriesSpec = WEEKLY, newest: int | None = None) -> DataFrame:
    """``forecast_weeks`` rows per series, built from its last observed row.

    Weeks count on from the last week of the whole frame, modulo 52, so a horizon that passes week 52
    moves to the next year. Lags up to the step look back on the last observed value; all other
    features are carried forward. ``newest`` is that last week as a number YYYYWW if it is known already.
    """
    # Year and week as one number: the latest year, and the latest week in it.
    newest = (features.agg(F.max(F.col("year") * 100 + F.col("week"))).scalar() if newest is None
              else F.lit(newest))
    max_year = F.floor(F.col("_newest") / 100).cast("int")
    max_week = F.pmod(F.col("_newest"), 100)
    step = F.col("semana")
    latest = last_observation(features, spec).withColumns({
        "semana": F.explode(F.sequence(F.lit(1), F.lit(forecast_weeks))),
        "_newest": newest,
    })
    turned = F.pmod(max_week + step, F.lit(WEEKS_PER_YEAR))
    week = F.when(turned == 0, WEEKS_PER_YEAR).otherwise(turned).cast("int")
    year = F.when(F.col("week") > max_week, max_year).otherwise(max_year + 1).cast("int")
    value = F.col(spec.target)
    lags = {}
    for k in HORIZON_LAGS:
        name = f"{spec.target}_lag_{k}"
        if name in features.columns:
            lags[name] = value if k == 1 else F.when(step >= k, value).otherwise(F.col(name))
    moved = latest.withColumn("week", week).withColumns({"year": year, **lags})
    sine, cosine = cyclical(F.col("week"), WEEKS_PER_YEAR)
    return (moved.withColumns({"week_sin": sine, "week_cos": cosine})
            .select(*dict.fromkeys([*features.columns, "week_sin", "week_cos"]), "semana"))


def prepare_forecast_features(horizon: DataFrame, drop_cols=None) -> DataFrame:
    """Drop what must not reach a model: the target, raw dates and the step number."""
    if drop_cols is None:
        drop_cols = ("quantity", "transaction_date", "reference_date", "semana")
    return horizon.drop(*drop_cols)
