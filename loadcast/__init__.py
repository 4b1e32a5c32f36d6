"""Leakage-safe forecasting and residual-anomaly analysis on Spark DataFrames."""

from .schema import DEFAULT_COLUMNS, FEATURE_COLUMNS, SeriesColumns
from .session import build_session

__all__ = ["DEFAULT_COLUMNS", "FEATURE_COLUMNS", "SeriesColumns", "build_session"]
