"""Calendar parts and their cyclical encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cycle lengths. ISO week 53 runs a little past a full turn.
CYCLES = {"month": 12, "week": 52, "day": 31, "dayofweek": 7}


def iso_week_year(date: Column) -> Column:
    """The year an ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), date).cast("int")


def calendar_columns(date: Column, week_year: str = "calendar") -> dict[str, Column]:
    """``year, month, week, day, dayofweek, is_weekend`` with Monday as day 0.

    ``week_year="calendar"`` pairs the calendar year with the ISO week, so 1 January may fall in
    week 52 or 53 of its own year; ``"iso"`` uses the year the ISO week belongs to.
    """
    if week_year not in ("calendar", "iso"):
        raise ValueError(f"week_year must be 'calendar' or 'iso', not {week_year!r}")
    weekday = F.weekday(date)
    return {
        "year": F.year(date) if week_year == "calendar" else iso_week_year(date),
        "month": F.month(date),
        "week": F.weekofyear(date),
        "day": F.dayofmonth(date),
        "dayofweek": weekday,
        "is_weekend": F.coalesce(weekday.isin(5, 6).cast("int"), F.lit(0)),
    }


def cyclical(value: Column, cycle: int) -> tuple[Column, Column]:
    """Sine and cosine of ``value`` as a position on a circle of ``cycle`` steps."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(cycle))
    return F.sin(angle), F.cos(angle)


def time_feature_columns(date: Column, week_year: str = "calendar") -> dict[str, Column]:
    """Calendar parts, month boundaries, quarter and the eight cyclical encodings."""
    columns = calendar_columns(date, week_year)
    columns["is_month_start"] = F.coalesce((F.dayofmonth(date) == 1).cast("int"), F.lit(0))
    columns["is_month_end"] = F.coalesce(
        (F.last_day(date) == F.to_date(date)).cast("int"), F.lit(0))
    columns["quarter"] = F.quarter(date)
    for name, cycle in CYCLES.items():
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclical(columns[name], cycle)
    return columns
