"""The tables behind a monitoring view of one date window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.calendar import default_window
from ..operators.anomaly import direction_mix, event_counts, severity_mix
from ..operators.daily import (
    Daily,
    daily_errors,
    daily_events,
    day_bounds,
    merged_events,
    merged_fit,
    merged_metrics,
    residual_range,
)
from ..operators.distribution import calibration_bounds, histogram
from ..operators.filters import in_days, members, report, with_errors
from ..operators.history import rolling_mae
from ..operators.layout import Layout
from ..operators.metrics import error_quantiles
from ..operators.ranking import most_severe, seeded_sample
from ..schema import DEFAULT_COLUMNS, DIRECTIONS, SEVERITY_LEVELS, SeriesColumns
from ..session import stage

TOP_EVENTS = 20


def daily_tables(predictions: DataFrame, anomalies: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> Daily:
    """The day rows of both tables, staged: what a store would keep and append new days to."""
    predictions = with_errors(predictions, cols)
    return Daily(stage(daily_errors(predictions, cols), "days"), stage(daily_events(anomalies, cols), "event-days"))


def monitoring_view(
    predictions: DataFrame,
    anomalies: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    severities: Sequence[str] = tuple(SEVERITY_LEVELS),
    directions: Sequence[str] = tuple(DIRECTIONS),
    cols: SeriesColumns = DEFAULT_COLUMNS,
    layout: Layout | None = None,
    daily: Daily | None = None,
) -> dict[str, DataFrame]:
    """Every table of the view. Without dates, the last 30 days of the data.

    The tables are read twice at most: once for the day rows, which give the dates, the metrics,
    the counts and the histogram's ends, and once for the rows of the window, which are staged.
    Only quantiles, the histogram's counts, the rolling error, the sample and the top events read
    those. With ``daily`` rows at hand, or both dates, the first pass is not needed; of
    predictions stored by day the second reads the window's folders only. Without a layout the
    chosen window itself is measured.
    """
    predictions = with_errors(predictions, cols)
    if daily is None and (start is None or end is None):
        daily = daily_tables(predictions, anomalies, cols)
    if start is None or end is None:
        found = day_bounds(daily.errors).first()
        first, last = default_window(found["min_date"], found["max_date"])
        start, end = start or first, end or last
    shown = stage(in_days(predictions, start, end, cols), "shown")
    flagged = stage(in_days(anomalies, start, end, cols), "shown-events")
    events = members(members(flagged, "severity", severities), "direction", directions)
    days = (daily or Daily(daily_errors(shown, cols), daily_events(flagged, cols))).window(start, end)
    counted = merged_events(days.events, severities, directions)
    sample = seeded_sample(shown, cols=cols)
    # One group over all series: its size is that of the whole window, not of a series.
    hot = layout.always_blocks or layout.n_rows > layout.rows_per_task if layout else None
    middle = error_quantiles(shown, cols.target, hot=hot)
    # One row, written: its scalars would otherwise be nested in those of a reader.
    quality = stage(
        merged_fit(days.errors).select("*", *(middle.select(c).scalar().alias(c) for c in middle.columns)), "quality"
    )
    return {
        "predictions": shown,
        "anomalies": events,
        "metrics": merged_metrics(days.errors),
        "quality": quality,
        "severity_mix": severity_mix(counted, weight="count"),
        "direction_mix": direction_mix(counted, weight="count"),
        "histogram": histogram(shown, ends=residual_range(days.errors)),
        "rolling_mae": rolling_mae(shown, cols, layout=layout),
        "sample": sample,
        "calibration_bounds": calibration_bounds(sample, cols.target),
        "top_events": top_events(events, cols=cols),
        "counts": event_counts(counted, weight="count"),
    }


def top_events(anomalies: DataFrame, k: int = TOP_EVENTS, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """The gravest events under their display names, rounded."""
    # The display names.
    shown = {
        cols.time: "Timestamp",
        cols.target: "Actual MW",
        "prediction": "Forecast MW",
        "residual": "Residual MW",
        "severity_score": "Severity Score",
        "direction": "Direction",
        "severity": "Severity",
    }
    digits = {cols.target: 1, "prediction": 1, "residual": 1, "severity_score": 2}
    return report(most_severe(anomalies, k, cols=cols), shown, digits)
