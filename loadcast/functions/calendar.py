"""Calendar fields and date arithmetic on the time axis."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLUMNS, SeriesColumns


def calendar_features(time: Column) -> dict[str, Column]:
    """Fields known in advance. ``weekday`` counts from Monday = 0."""
    return {
        "hour": F.hour(time),
        "day_of_week": F.weekday(time),
        "month": F.month(time),
        "day_of_year": F.dayofyear(time),
        "is_weekend": (F.weekday(time) >= 5).cast("int"),
    }


def with_calendar(df: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    if cols.time not in df.columns:
        raise ValueError(f"Missing required column: {cols.time}")
    return df.withColumns(calendar_features(F.col(cols.time)))


def floor_day(time: Column) -> Column:
    return time.cast("date").cast("timestamp_ntz")


def floor_hour(time: Column) -> Column:
    """Start of the hour, computed without a zone so no daylight-saving shift applies."""
    return floor_day(time) + F.make_dt_interval(hours=F.hour(time))


def day_window(time: Column, start: dt.date, end: dt.date) -> Column:
    """Rows from the first instant of ``start`` to the last one of ``end``.

    Compared against literals, so the predicate reaches the parquet scan.
    """
    after = end + dt.timedelta(days=1)
    return (time >= F.lit(start.isoformat()).cast("timestamp_ntz")) & (
        time < F.lit(after.isoformat()).cast("timestamp_ntz")
    )


def default_window(first: dt.date, last: dt.date, days: int = 30) -> tuple[dt.date, dt.date]:
    """The last ``days`` calendar days, clipped to the data."""
    return max(first, last - dt.timedelta(days=days - 1)), last
