"""Residual histogram and calibration-line bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: most bins a histogram has.
HISTOGRAM_BINS = 55


def histogram(
    df: DataFrame,
    column: str = "residual",
    bins: int = HISTOGRAM_BINS,
    by: Sequence[str] = (),
    ends: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Counts over equal bins between the smallest and largest value, which falls in the last bin.

    Two aggregations: bounds, then counts. Both combine before the shuffle, and
    without groups the bounds are a scalar subquery. ``ends`` gives bounds already known.
    """
    by = list(by)
    value = F.col(column)
    bounds = df.groupBy(*by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    rows = df.select(*by, value)
    if ends and not by:
        placed = rows.withColumns(dict(zip(("_low", "_high"), ends, strict=True)))
    elif by:
        placed = rows.join(bounds, by)
    else:
        placed = rows.withColumns({name: bounds.select(name).scalar() for name in ("_low", "_high")})
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.floor(F.try_divide(value - F.col("_low"), width))
    number = F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int")
    counted = placed.where(value.isNotNull()).groupBy(*by, "_low", "_high", number.alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.select(
        *by,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "count",
    )


def calibration_bounds(
    df: DataFrame, actual: str = "y", predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Ends of the perfect-forecast line: the range shared by actual and predicted."""
    return df.groupBy(*by).agg(
        F.least(F.min(actual), F.min(predicted)).alias("min_value"),
        F.greatest(F.max(actual), F.max(predicted)).alias("max_value"),
    )
