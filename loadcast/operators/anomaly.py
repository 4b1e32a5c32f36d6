"""Residual threshold, anomaly scoring and the anomaly summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import ensure_finite
from ..functions.grading import anomaly_flag, direction, severity, severity_score
from ..functions.text import iso_timestamp
from ..schema import (
    DEFAULT_COLUMNS,
    SEVERITY_LEVELS,
    VALIDATION,
    SeriesColumns,
    require_between,
    require_columns,
    require_positive,
)
from .layout import join_by_series
from .ranking import top_k
from .quantiles import attach, group_quantiles

# Fixed value: quantile of the absolute validation residuals.
THRESHOLD_QUANTILE = 0.99


def fit_residual_threshold(
    calibration: DataFrame,
    by: Sequence[str] = (),
    quantile: float = THRESHOLD_QUANTILE,
    actual: str = "y",
    predicted: str = "prediction",
    hot: bool | None = None,
    strict: bool | None = None,
) -> DataFrame:
    """``(group, quantile, threshold, status)``: the exact quantile of the absolute residuals.

    Give it rows the predicting model has not seen. ``strict`` fails the job when a
    threshold is missing or not positive. Otherwise such a group gets no threshold,
    and ``status`` says why; the other groups are not affected. By default a single
    threshold is strict, one per group is not.
    """
    strict = not by if strict is None else strict
    require_between("quantile", quantile)
    residual = F.abs(F.col(actual) - F.col(predicted))
    fitted = group_quantiles(calibration, by, residual, {"threshold": quantile}, hot=hot, name="residuals")
    empty = F.raise_error(F.lit("the calibration residuals must not be empty")).cast("double")
    found = F.col("threshold")
    if strict:
        checked = F.when(found.isNull(), empty).otherwise(_positive(found, strict))
    else:
        checked = _positive(found, strict)
    return fitted.select(
        *by, F.lit(float(quantile)).alias("quantile"), checked.alias("threshold"), threshold_status(found).alias("status")
    )


OK, NO_ROWS, NOT_POSITIVE = "ok", "no calibration rows", "not positive"


def threshold_status(threshold: Column) -> Column:
    """Whether a fitted quantile can serve as a threshold."""
    return F.when(threshold.isNull(), NO_ROWS).when(threshold <= 0, NOT_POSITIVE).otherwise(OK)


def _positive(threshold: Column, strict: bool) -> Column:
    failure = F.raise_error(F.lit("the fitted threshold must be positive")) if strict else F.lit(None)
    return F.when(threshold <= 0, failure.cast("double")).otherwise(threshold)


def for_every_series(thresholds: DataFrame, rows: DataFrame, cols: SeriesColumns, quantile: float) -> DataFrame:
    """The thresholds with a row for each series of ``rows``, also for those without calibration rows."""
    series = rows.select(cols.series).distinct()
    return series.join(thresholds, cols.series, "left").select(
        cols.series,
        F.lit(float(quantile)).alias("quantile"),
        "threshold",
        F.coalesce("status", F.lit(NO_ROWS)).alias("status"),
    )


def with_series_threshold(
    frame: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    predicted: str = "prediction",
    quantile: float = THRESHOLD_QUANTILE,
    strict: bool = False,
) -> DataFrame:
    """Add the same threshold and status as window columns, for series that fit one task.

    Only validation rows enter the quantile.
    """
    require_between("quantile", quantile)
    error = ensure_finite(F.col(cols.target) - F.col(predicted), "residuals")
    unseen = F.when(F.col("split") == VALIDATION, F.abs(error))
    fitted = F.percentile(unseen, float(quantile)).over(Window.partitionBy(cols.series))
    # Two steps, so that the window is evaluated once.
    found = F.col("_fitted")
    return (
        frame.withColumn("_fitted", fitted)
        .withColumns({"threshold": _positive(found, strict), "status": threshold_status(found)})
        .drop("_fitted")
    )


def score_columns(actual: Column, predicted: Column, threshold: Column) -> dict[str, Column]:
    """Row-wise scoring for a frozen threshold; also valid on a streaming DataFrame."""
    error = ensure_finite(actual, "actual") - ensure_finite(predicted, "predicted")
    size = F.abs(error)
    flag = anomaly_flag(size, threshold)
    score = severity_score(size, threshold)
    return {
        "residual": error,
        "absolute_residual": size,
        "is_anomaly": flag,
        "severity_score": score,
        "direction": direction(error),
        "severity": severity(score, flag),
    }


def score_anomalies(
    predictions: DataFrame,
    threshold: float | Column | DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    predicted: str = "prediction",
    n_series: int | None = None,
) -> DataFrame:
    """Flag and grade every row against a number, a column, or a table of one threshold per series.

    Rows of a series without a threshold are kept, with the flag, score and
    severity unknown.
    """
    require_columns(predictions, [cols.time, cols.target, predicted])
    if isinstance(threshold, Column):
        bound, limit = predictions, threshold
    elif not isinstance(threshold, DataFrame):
        require_positive("threshold", threshold)
        bound, limit = predictions, F.lit(float(threshold))
    else:
        limits = threshold.select(cols.series, F.col("threshold").alias("_threshold"))
        limit = F.col("_threshold")
        bound = join_by_series(predictions, limits, cols.series, n_series, "left")
    kept = [c for c in (cols.series, cols.time, cols.target) if c in predictions.columns]
    scored = score_columns(F.col(cols.target), F.col(predicted), limit)
    return bound.select(
        *kept, F.col(predicted).alias("prediction"), *[value.alias(name) for name, value in scored.items()]
    )


def anomalies_only(scored: DataFrame) -> DataFrame:
    return scored.where("is_anomaly")


def anomaly_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Scored rows, anomalies, their rate in percent of all scored rows, and both directions."""
    return scored.groupBy(*by).agg(*_count_columns())


def _count_columns() -> list[Column]:
    flagged = F.col("is_anomaly")
    return [
        F.count(F.lit(1)).alias("total_scored_rows"),
        F.count_if(flagged).alias("anomaly_count"),
        (F.try_divide(F.count_if(flagged), F.count(F.lit(1))) * 100).alias("anomaly_rate_percent"),
        F.count_if(flagged & (F.col("direction") == "spike")).alias("spike_count"),
        F.count_if(flagged & (F.col("direction") == "drop")).alias("drop_count"),
        F.count_if(flagged & (F.col("severity") == "critical")).alias("critical_count"),
    ]


def severity_counts(anomalies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Only the levels that occur."""
    return anomalies.groupBy(*by, "severity").agg(F.count(F.lit(1)).alias("count"))


def _occurrences(condition: Column, weight: str | None) -> Column:
    """Rows that meet a condition, or with a ``weight`` column the sum of it over them."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def severity_mix(anomalies: DataFrame, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """All three levels in fixed order, zero where none occurred.

    Counted in one pass and unpivoted, so no join is needed for the zeros. With a ``weight``
    column a row stands for so many anomalies.
    """
    counts = anomalies.groupBy(*by).agg(
        *[_occurrences(F.col("severity") == s, weight).alias(s) for s in SEVERITY_LEVELS]
    )
    levels = F.array(
        *[
            F.struct(F.lit(i).alias("level"), F.lit(s).alias("severity"), F.col(s).alias("count"))
            for i, s in enumerate(SEVERITY_LEVELS, start=1)
        ]
    )
    return counts.select(*by, F.inline(levels))


def event_counts(anomalies: DataFrame, weight: str | None = None) -> DataFrame:
    """Spikes, drops and critical cases; one row, zeros without anomalies."""
    return anomalies.agg(
        _occurrences(F.col("direction") == "spike", weight).alias("spike_count"),
        _occurrences(F.col("direction") == "drop", weight).alias("drop_count"),
        _occurrences(F.col("severity") == "critical", weight).alias("critical_count"),
    )


def direction_mix(anomalies: DataFrame, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Spikes and drops, their shares of both, and which dominates."""
    counts = anomalies.groupBy(*by).agg(
        _occurrences(F.col("direction") == "spike", weight).alias("spike_count"),
        _occurrences(F.col("direction") == "drop", weight).alias("drop_count"),
    )
    spikes, drops = F.col("spike_count"), F.col("drop_count")

    def share(count: Column) -> Column:
        return F.coalesce(F.try_divide(count * F.lit(100.0), spikes + drops), F.lit(0.0))

    dominant = F.when(spikes > drops, "SPIKES").when(drops > spikes, "DROPS").otherwise("BALANCED")
    return counts.select(
        *by,
        spikes,
        drops,
        share(spikes).alias("spike_pct"),
        share(drops).alias("drop_pct"),
        dominant.alias("dominant_direction"),
    )


def top_anomaly_records(
    scored: DataFrame, by: Sequence[str] = (), k: int = 10, cols: SeriesColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """The ``k`` gravest anomalies as one array of records per group."""
    ranked = top_k(anomalies_only(scored), k, [F.desc("severity_score"), F.asc(cols.time)], by, rank="_rank")
    record = F.struct(
        F.col("_rank"),
        iso_timestamp(F.col(cols.time)).alias("datetime"),
        F.col(cols.target).alias("actual_mw"),
        F.col("prediction").alias("prediction_mw"),
        F.col("residual").alias("residual_mw"),
        F.col("absolute_residual").alias("absolute_residual_mw"),
        "severity_score",
        "direction",
        "severity",
    )
    # At most k records per group are gathered.
    gathered = ranked.groupBy(*by).agg(F.array_sort(F.collect_list(record)).alias("_records"))
    return gathered.select(
        *by, F.transform("_records", lambda r: r.dropFields("_rank")).alias("top_anomalies")
    )


def anomaly_summary(
    scored: DataFrame,
    thresholds: DataFrame,
    by: Sequence[str] = (),
    k: int = 10,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    calibration_model: str = "RandomForestRegressor",
) -> DataFrame:
    """One run record per group: provenance, counts, severity map and the gravest cases."""
    by = list(by)
    flagged = F.col("is_anomaly")
    levels = F.array(
        *[
            F.struct(F.lit(s).alias("key"), F.count_if(flagged & (F.col("severity") == s)).alias("value"))
            for s in SEVERITY_LEVELS
        ]
    )
    counts = scored.groupBy(*by).agg(*_count_columns(), levels.alias("_levels"))
    occurring = F.map_from_entries(F.filter(F.col("_levels"), lambda e: e["value"] > 0))
    top = top_anomaly_records(scored, by, k, cols)
    fitted = thresholds.select(
        *by, F.col("quantile").alias("threshold_quantile"), F.col("threshold").alias("threshold_mw")
    )
    joined = attach(attach(counts, top, by), fitted, by).withColumn("severity_counts", occurring)
    no_records = F.array().cast(top.schema["top_anomalies"].dataType)
    return joined.select(
        *by,
        F.lit("absolute_forecast_residual_quantile").alias("method"),
        F.lit(calibration_model).alias("calibration_model"),
        F.lit("train_only").alias("calibration_model_training_scope"),
        F.lit("unseen_validation_residuals").alias("threshold_source"),
        "threshold_quantile",
        "threshold_mw",
        F.lit("scoring_only").alias("final_test_usage"),
        "total_scored_rows",
        "anomaly_count",
        "anomaly_rate_percent",
        "spike_count",
        "drop_count",
        "severity_counts",
        F.coalesce("top_anomalies", no_records).alias("top_anomalies"),
        F.lit(False).alias("threshold_fit_on_final_test"),
        F.lit(False).alias("threshold_fit_on_training_rows"),
        F.lit(False).alias("validation_seen_by_calibration_model"),
    )
