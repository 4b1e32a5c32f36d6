"""Filters and reporting projections of the monitoring view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions.calendar import day_window
from ..functions.errors import error_columns
from ..schema import DAY, DEFAULT_COLUMNS, SeriesColumns, require_columns


def in_days(df: DataFrame, start: dt.date, end: dt.date, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows of the days ``start`` to ``end``, both whole.

    Of a table stored by day the days themselves are compared, too, so that only their folders
    are listed and read.
    """
    shown = day_window(F.col(cols.time), start, end)
    if DAY in df.columns and isinstance(df.schema[DAY].dataType, DateType):
        shown &= F.col(DAY).between(F.lit(start), F.lit(end))
    return df.where(shown)


def members(df: DataFrame, column: str, selected: Sequence[str]) -> DataFrame:
    """Rows whose value was selected; an empty selection selects nothing."""
    return df.where(F.col(column).isin(list(selected)) if selected else F.lit(False))


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def report(df: DataFrame, names: Mapping[str, str], digits: Mapping[str, int] | None = None) -> DataFrame:
    """Select, rename and round half to even, for display."""
    digits = digits or {}
    return df.select(
        *[
            (F.bround(F.col(source), digits[source]) if source in digits else F.col(source)).alias(shown)
            for source, shown in names.items()
        ]
    )


def with_errors(predictions: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Fill in ``residual`` when it is absent; always recompute ``absolute_error`` from it."""
    require_columns(predictions, [cols.target, "prediction"])
    if "residual" not in predictions.columns:
        predictions = predictions.withColumn("residual", error_columns(cols.target)["residual"])
    return predictions.withColumn("absolute_error", F.abs("residual"))
