"""Row-wise anomaly scoring for a streaming DataFrame.

Scoring keeps no state: the threshold is frozen before the stream starts, so the
batch expressions apply unchanged and no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.anomaly import score_anomalies
from ..schema import DEFAULT_COLUMNS, SeriesColumns


def score_stream(
    predictions: DataFrame,
    threshold: float | DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    n_series: int | None = None,
) -> DataFrame:
    """Score a stream of predictions; a threshold table is joined as a static side."""
    if not predictions.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame")
    return score_anomalies(predictions, threshold, cols, n_series=n_series)
