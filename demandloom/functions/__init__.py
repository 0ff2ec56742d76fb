"""Column expressions: calendar, cyclical encoding and guarded arithmetic."""

from .calendar import calendar_columns, cyclical, iso_week_year, time_feature_columns
from .numeric import finite, nonnegative_units, safe_ratio

__all__ = [
    "calendar_columns", "cyclical", "finite", "iso_week_year", "nonnegative_units",
    "safe_ratio", "time_feature_columns",
]
