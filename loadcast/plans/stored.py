"""The view of a stored run: what it needs, and what it shows if it is there."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import (
    BACKTEST_SCHEMA,
    COMPARISON_SCHEMA,
    DEFAULT_COLUMNS,
    DIRECTIONS,
    IMPORTANCE_SCHEMA,
    SEVERITY_LEVELS,
    SeriesColumns,
    anomalies_schema,
)
from ..sources import load_predictions, load_record, optional_table, require_paths
from .monitoring import monitoring_view


@dataclass(frozen=True)
class StoredView:
    """``tables`` of the window, the run's records, and the optional tables, empty if never written."""

    tables: dict[str, DataFrame]
    metrics: DataFrame
    anomaly_summary: DataFrame
    comparison: DataFrame
    importance: DataFrame
    backtest: DataFrame


def stored_view(
    spark: SparkSession,
    output: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    severities: Sequence[str] = tuple(SEVERITY_LEVELS),
    directions: Sequence[str] = tuple(DIRECTIONS),
    cols: SeriesColumns = DEFAULT_COLUMNS,
) -> StoredView:
    """Read a run's folder. Predictions, final metrics and the anomaly summary are required, all
    missing ones are named at once; anomalies, comparison, importance and backtest are optional.
    """

    def path(*parts: str) -> str:
        return "/".join([output.rstrip("/"), *parts])

    predictions, metrics, summary = (
        path("predictions", "final_test"), path("metrics", "final_test_metrics"), path("metrics", "anomaly_summary")
    )
    require_paths(spark, [predictions, metrics, summary])
    events = optional_table(spark, path("anomalies", "final_test"), anomalies_schema(cols), "csv")
    return StoredView(
        monitoring_view(load_predictions(spark, predictions, cols), events, start, end, severities, directions, cols),
        load_record(spark, metrics),
        load_record(spark, summary),
        optional_table(spark, path("metrics", "model_comparison_table"), COMPARISON_SCHEMA),
        optional_table(spark, path("metrics", "feature_importance"), IMPORTANCE_SCHEMA, "csv"),
        optional_table(spark, path("metrics", "backtest_results"), BACKTEST_SCHEMA),
    )
