"""Scoring the horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nonnegative_units
from ..operators.horizon import generate_forecast_features, prepare_forecast_features
from ..spec import PRODUCT, STORE, WEEKLY, SeriesSpec
from .train import PREDICTION, SalesModel


def score(model: SalesModel, horizon: DataFrame) -> DataFrame:
    """Predicted units, rounded half to even and not negative, under the output names.

    The model sees no target, date or step number of the horizon; the step is kept beside its inputs.
    """
    hidden = [c for c in horizon.columns if c not in prepare_forecast_features(horizon).columns]
    beside = horizon.withColumnsRenamed({c: f"_{c}" for c in hidden})
    scored = model.transform(beside).withColumnsRenamed({f"_{c}": c for c in hidden})
    return scored.withColumns({
        "quantidade": nonnegative_units(F.col(PREDICTION)),
        "pdv": F.col(STORE),
        "produto": F.col(PRODUCT),
    })


def generate_forecast(model: SalesModel, features: DataFrame, forecast_weeks: int = 5,
                      spec: SeriesSpec = WEEKLY) -> DataFrame:
    """``semana, pdv, produto, quantidade`` for every series and step."""
    horizon = generate_forecast_features(features, forecast_weeks, spec)
    return score(model, horizon).select("semana", "pdv", "produto", "quantidade")
