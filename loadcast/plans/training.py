"""Train the baseline forest and record how it does on validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import metric_columns
from ..operators.models import SEED, fit_model, predict, random_forest
from ..operators.split import part
from ..schema import DEFAULT_COLUMNS, FEATURE_COLUMNS, TEST, TRAIN, VALIDATION, SeriesColumns


@dataclass(frozen=True)
class TrainingRun:
    model: PipelineModel
    metrics: DataFrame
    metadata: DataFrame


def paired_metrics(rows: DataFrame, actual: str, predicted: str, naive: str = "lag_168") -> DataFrame:
    """Model and naive metrics from one pass over the scored rows, with the improvement."""
    model, baseline = metric_columns(actual, predicted), metric_columns(actual, naive)
    measured = rows.agg(F.struct(*baseline).alias("seasonal_naive"), F.struct(*model).alias("random_forest"))
    base, own = F.col("seasonal_naive.MAPE"), F.col("random_forest.MAPE")
    return measured.withColumn("mape_improvement_percent", F.try_divide(base - own, base) * 100)


def run_metadata(frame: DataFrame, target: str) -> DataFrame:
    return frame.agg(
        F.lit("RandomForestRegressor").alias("model_type"),
        F.lit(target).alias("target_column"),
        F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("feature_columns"),
        *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in (TRAIN, VALIDATION, TEST)],
        F.lit(False).alias("test_set_evaluated"),
        F.lit(SEED).alias("random_state"),
    )


def train_baseline(
    frame: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, estimator: Pipeline | None = None
) -> TrainingRun:
    """Fit on train rows, measure on validation rows. Test rows are only counted."""
    model = fit_model(estimator or random_forest(cols.target), part(frame, TRAIN), cols)
    scored = predict(model, part(frame, VALIDATION))
    return TrainingRun(model, paired_metrics(scored, cols.target, "prediction"), run_metadata(frame, cols.target))
