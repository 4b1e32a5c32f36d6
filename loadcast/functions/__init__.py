"""Column expressions. Everything here is a built-in Spark expression; no Python UDFs."""

from .calendar import calendar_features, day_window, default_window, floor_day, floor_hour, with_calendar
from .errors import (
    absolute_percentage_error,
    cut_index,
    ensure_finite,
    error_columns,
    is_finite,
    nan_to_null,
    residual,
)
from .grading import anomaly_flag, direction, severity, severity_score
from .text import iso_timestamp, label

__all__ = [
    "absolute_percentage_error",
    "anomaly_flag",
    "calendar_features",
    "cut_index",
    "day_window",
    "default_window",
    "direction",
    "ensure_finite",
    "error_columns",
    "floor_day",
    "floor_hour",
    "is_finite",
    "iso_timestamp",
    "label",
    "nan_to_null",
    "residual",
    "severity",
    "severity_score",
    "with_calendar",
]
