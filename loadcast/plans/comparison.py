"""Compare candidate models on the validation rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import error_metrics, relative_improvement
from ..operators.models import gradient_boosting, timed_fit, timed_predict
from ..operators.ranking import rank_models
from ..operators.split import part
from ..schema import (
    DEFAULT_COLUMNS,
    GRADIENT_BOOSTING,
    RANDOM_FOREST,
    SEASONAL_NAIVE,
    TRAIN,
    VALIDATION,
    SeriesColumns,
)
from ..session import stage
from ..sources.models import save_model


def as_model(rows: DataFrame, model: str, prediction: str, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows of the long prediction table for one model."""
    kept = [c for c in ("split", "fold") if c in rows.columns]
    return rows.select(*cols.key, cols.target, *kept, F.lit(model).alias("model"), F.col(prediction).alias("prediction"))


def comparison_table(
    predictions: DataFrame,
    by: Sequence[str] = (),
    cols: SeriesColumns = DEFAULT_COLUMNS,
    timings: DataFrame | None = None,
    baseline: str = SEASONAL_NAIVE,
) -> DataFrame:
    """Metrics per model, best MAPE first, with the improvement over the baseline."""
    measured = error_metrics(predictions, [*by, "model"], cols.target)
    if timings is not None:
        # One row per model.
        measured = measured.join(F.broadcast(timings), "model", "left").select(
            *by, "model", "MAE", "RMSE", "MAPE", "train_seconds", "predict_seconds"
        )
    return rank_models(relative_improvement(measured, baseline, by), ["MAPE"], by)


def comparison_record(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One record per group: every model's numbers and the winner's."""
    best = F.col("rank") == 1
    numbers = [c for c in ("MAE", "RMSE", "MAPE", "train_seconds", "predict_seconds") if c in table.columns]
    return table.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("model", F.struct(*numbers)))).alias("models"),
        F.max(F.when(best, F.col("model"))).alias("validation_winner"),
        F.max(F.when(best, F.col("MAPE"))).alias("winner_mape"),
        F.max(F.when(best, F.col("mape_improvement_percent"))).alias("winner_relative_mape_improvement_percent"),
        F.lit(False).alias("test_set_evaluated"),
    )


@dataclass(frozen=True)
class Comparison:
    table: DataFrame
    record: DataFrame
    challenger: PipelineModel
    winner: str


def compare_models(
    frame: DataFrame,
    forest: PipelineModel,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    challenger: Pipeline | None = None,
    challenger_path: str | None = None,
) -> Comparison:
    """Naive, saved forest and a newly trained challenger on validation.

    The challenger is saved only when it wins.
    """
    validation = part(frame, VALIDATION)
    forest_rows, forest_seconds = timed_predict(forest, validation, cols)
    boosted, fit_seconds = timed_fit(challenger or gradient_boosting(cols.target), part(frame, TRAIN), cols)
    boosted_rows, boosted_seconds = timed_predict(boosted, validation, cols)
    predictions = (
        as_model(validation, SEASONAL_NAIVE, "lag_168", cols)
        .drop("split")
        .unionByName(as_model(forest_rows, RANDOM_FOREST, "prediction", cols))
        .unionByName(as_model(boosted_rows, GRADIENT_BOOSTING, "prediction", cols))
    )
    timings = frame.sparkSession.createDataFrame(
        [
            (SEASONAL_NAIVE, 0.0, 0.0),
            (RANDOM_FOREST, None, forest_seconds),
            (GRADIENT_BOOSTING, fit_seconds, boosted_seconds),
        ],
        "model string, train_seconds double, predict_seconds double",
    )
    # Three rows, computed once: the winner and the table agree.
    table = stage(comparison_table(predictions, (), cols, timings), "comparison")
    winner = table.where("rank = 1").first()["model"]
    if winner == GRADIENT_BOOSTING and challenger_path:
        save_model(boosted, challenger_path)
    return Comparison(table, comparison_record(table), boosted, winner)
