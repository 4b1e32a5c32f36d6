"""Forecast-error expressions and numeric guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def ensure_finite(value: Column, name: str) -> Column:
    """``value``, failing the job on NULL, NaN or infinity, with no extra pass over the data."""
    message = F.raise_error(F.lit(f"{name} must contain only finite values."))
    return F.when(is_finite(value), value).otherwise(message.cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def residual(actual: Column, predicted: Column) -> Column:
    """Positive when demand was above the forecast."""
    return actual - predicted


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    """NULL where the actual value is zero."""
    return F.try_divide(F.abs(actual - predicted), F.abs(actual)) * 100


def error_columns(actual: str, predicted: str = "prediction") -> dict[str, Column]:
    error = residual(F.col(actual), F.col(predicted))
    return {"residual": error, "absolute_error": F.abs(error)}


def cut_index(count: Column, ratio: float) -> Column:
    """Truncated ``count * ratio`` in double arithmetic (decimals truncate differently)."""
    return F.floor(count.cast("double") * F.lit(float(ratio))).cast("bigint")
