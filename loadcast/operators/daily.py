"""Mergeable rows for each day: any window of days is merged from them without reading rows again.

A day's row has counts, sums, squared deviations and extremes; events have a row for each day,
severity and direction. Both are partial-then-final aggregations, and small beside what they
summarise: days, whatever the number of series. Rows of new days are appended to stored ones.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import ensure_finite
from ..schema import DAY, DEFAULT_COLUMNS, SeriesColumns

@dataclass(frozen=True)
class Daily:
    """``errors``: a row for each day; ``events``: one for each day, severity and direction."""

    errors: DataFrame
    events: DataFrame

    def window(self, start: dt.date, end: dt.date) -> Daily:
        """The days ``start`` to ``end``, both whole."""
        shown = F.col(DAY).between(F.lit(start), F.lit(end))
        return Daily(self.errors.where(shown), self.events.where(shown))


def daily_errors(predictions: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """What the errors of each day add up to."""
    y = ensure_finite(F.col(cols.target), "y_true")
    predicted = ensure_finite(F.col("prediction"), "y_pred")
    e = y - predicted
    relative = F.abs(F.try_divide(e, y))
    return predictions.groupBy(F.to_date(cols.time).alias(DAY)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(e).alias("error"),
        F.sum(F.abs(e)).alias("absolute"),
        F.sum(e * e).alias("squared"),
        F.sum(relative).alias("relative"),
        F.count(relative).alias("relative_rows"),
        F.sum(y).alias("target"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("target_spread"),
        F.min("residual").alias("residual_low"),
        F.max("residual").alias("residual_high"),
    )


def daily_events(anomalies: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Anomalies of each day, severity and direction."""
    day = F.to_date(cols.time).alias(DAY)
    return anomalies.groupBy(day, "severity", "direction").agg(F.count(F.lit(1)).alias("count"))


def day_bounds(errors: DataFrame) -> DataFrame:
    return errors.agg(F.min(DAY).alias("min_date"), F.max(DAY).alias("max_date"))


def merged_metrics(errors: DataFrame) -> DataFrame:
    """``mae, rmse, mape`` of all given days; NaN where there are no rows, or no target but zero."""
    n = F.sum("rows")
    values = {
        "mae": F.try_divide(F.sum("absolute"), n),
        "rmse": F.sqrt(F.try_divide(F.sum("squared"), n)),
        "mape": F.try_divide(F.sum("relative"), F.sum("relative_rows")) * 100,
    }
    return errors.agg(*(_or_nan(v).alias(name) for name, v in values.items()))


def merged_fit(errors: DataFrame) -> DataFrame:
    """``r2`` and ``bias`` of all given days.

    The spread of all targets is that inside the days and that of the days' means round the mean
    of all: nothing is lost by subtracting large sums of squares.
    """
    # A window over all of a few rows: one for each day.
    every = Window.partitionBy(F.lit(0))
    mean = F.try_divide(F.sum("target").over(every), F.sum("rows").over(every))
    apart = F.try_divide(F.col("target"), F.col("rows")) - F.col("mean")
    errors = errors.withColumn("mean", mean).withColumn("apart", apart)
    n, unexplained = F.sum("rows"), F.sum("squared")
    total = F.sum(F.col("target_spread") + F.col("rows") * F.col("apart") * F.col("apart"))
    constant = F.when(unexplained == 0, 1.0).otherwise(0.0)
    r2 = F.when(total == 0, constant).otherwise(1 - F.try_divide(unexplained, total))
    return errors.agg(
        F.when(n >= 2, r2).otherwise(F.lit(float("nan"))).alias("r2"), _or_nan(F.try_divide(F.sum("error"), n)).alias("bias")
    )


def merged_events(events: DataFrame, severities: Sequence[str], directions: Sequence[str]) -> DataFrame:
    """One row per severity and direction chosen, for the counting operators, with how many there are."""
    chosen = F.col("severity").isin(list(severities)) & F.col("direction").isin(list(directions))
    rows = events.where(chosen if severities and directions else F.lit(False))
    return rows.groupBy("severity", "direction").agg(F.sum("count").alias("count"))


def residual_range(errors: DataFrame) -> tuple[Column, Column]:
    """Smallest and largest residual of the given days, as values in a plan."""
    low = errors.agg(F.min("residual_low").alias("low")).scalar()
    return low, errors.agg(F.max("residual_high").alias("high")).scalar()


def _or_nan(value: Column) -> Column:
    return F.coalesce(value, F.lit(float("nan")))
