"""Calibrate a residual threshold on unseen validation rows, then grade the test rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.alignment import validate_predictions
from ..operators.anomaly import (
    THRESHOLD_QUANTILE,
    anomalies_only,
    anomaly_summary,
    fit_residual_threshold,
    for_every_series,
    score_anomalies,
    with_series_threshold,
)
from ..operators.layout import Layout, measure
from ..operators.models import predict, random_forest, timed_fit
from ..operators.split import part
from ..schema import DEFAULT_COLUMNS, TEST, TRAIN, VALIDATION, SeriesColumns
from ..session import stage


@dataclass(frozen=True)
class Detection:
    thresholds: DataFrame
    scored: DataFrame
    anomalies: DataFrame
    summary: DataFrame


def detect(
    calibration: DataFrame,
    predictions: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    quantile: float = THRESHOLD_QUANTILE,
    layout: Layout | None = None,
    calibrated_by: str = "prediction",
    scored_by: str = "prediction",
    staged: bool = False,
) -> Detection:
    """One threshold per series from ``calibration`` rows, applied to ``predictions``.

    Every series of either table has a row in ``thresholds``; without a usable one its
    rows are kept with the flag unknown.
    The thresholds stay in the plan; none is fetched to the driver. ``staged``
    writes thresholds and scored rows first, for callers that go on to read the
    summary, the anomalies and the scored rows.
    """
    by = [cols.series]
    thresholds = fit_residual_threshold(
        calibration, by, quantile, cols.target, calibrated_by, hot=layout.blocked if layout else None
    )
    both = calibration.select(cols.series).unionByName(predictions.select(cols.series))
    thresholds = for_every_series(thresholds, both, cols, quantile)
    if staged:
        thresholds = stage(thresholds, "thresholds")
    scored = score_anomalies(predictions, thresholds, cols, scored_by, layout.n_series if layout else None)
    return _detection(scored, thresholds, cols, staged)


def _detection(scored: DataFrame, thresholds: DataFrame, cols: SeriesColumns, staged: bool) -> Detection:
    if staged:
        scored = stage(scored, "scored")
    summary = anomaly_summary(scored, thresholds, [cols.series], cols=cols)
    return Detection(thresholds, scored, anomalies_only(scored), summary)


def detect_within(
    frame: DataFrame,
    predicted: str,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    quantile: float = THRESHOLD_QUANTILE,
    layout: Layout | None = None,
    staged: bool = False,
) -> Detection:
    """Calibrate and score a predictor that is already a column of the prepared frame.

    While a series fits one task its threshold is a window over the partition the
    features were built in: no join, and the frame is computed once. With a long
    series the frame is staged and the two passes read it.
    """
    layout = layout or measure(frame, cols.series)
    if layout.blocked:
        wanted = part(frame, VALIDATION, TEST).select(*cols.key, cols.target, predicted, "split")
        frame = stage(wanted, "predicted", ["split"])
        return detect(part(frame, VALIDATION), part(frame, TEST), cols, quantile, layout, predicted, predicted, staged)
    limited = with_series_threshold(frame, cols, predicted, quantile)
    if staged:
        limited = stage(
            part(limited, TEST).select(*cols.key, cols.target, predicted, "split", "threshold", "status"), "limited"
        )
    thresholds = part(limited, VALIDATION, TEST).groupBy(cols.series).agg(
        F.lit(float(quantile)).alias("quantile"), F.first("threshold").alias("threshold"), F.first("status").alias("status")
    )
    # Scoring is a projection; staged, it is redone per reader rather than written again.
    scored = score_anomalies(part(limited, TEST), F.col("threshold"), cols, predicted)
    return _detection(scored, thresholds, cols, staged=False)


def calibrate_and_detect(
    frame: DataFrame,
    predictions: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    estimator: Pipeline | None = None,
    quantile: float = THRESHOLD_QUANTILE,
    layout: Layout | None = None,
) -> Detection:
    """The full run: a model trained on train rows only predicts validation, whose
    residuals set the threshold; the saved predictions of the final model are
    checked against the reserved rows and scored.
    """
    model, _ = timed_fit(estimator or random_forest(cols.target), part(frame, TRAIN), cols)
    unseen = stage(
        predict(model, part(frame, VALIDATION)).select(*cols.key, cols.target, "prediction"), "calibration"
    )
    validate_predictions(predictions, part(frame, TEST), cols)
    return detect(unseen, predictions, cols, quantile, layout, staged=True)
