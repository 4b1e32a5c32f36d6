"""Evaluate the selected model once on the reserved test rows."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.errors import error_columns
from ..operators.metrics import metric_columns
from ..operators.models import predict, random_forest, timed_fit
from ..operators.split import development, part
from ..schema import DEFAULT_COLUMNS, RANDOM_FOREST, TEST, SeriesColumns
from ..session import stage
from ..sources.claims import claim_once
from .selection import confirm_untouched


@dataclass(frozen=True)
class FinalEvaluation:
    model: PipelineModel
    predictions: DataFrame
    record: DataFrame


def final_evaluation(
    frame: DataFrame,
    selection: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    estimator: Pipeline | None = None,
    expected: str = RANDOM_FOREST,
    claim: str | None = None,
) -> FinalEvaluation:
    """Fit on train and validation, score the test rows once, record both models' metrics.

    Refused when another model was selected or the selection does not say that the test rows
    are untouched. With a ``claim``, a folder beside the results, it is also refused when any
    application has scored them before: the folder is claimed after the fit and before the first
    test row is read. The returned record says they are used up.
    """
    chosen = selection.select("selected_model").first()[0]
    if chosen != expected:
        raise ValueError(f"Final evaluation expected {expected}, but selection artifact contains {chosen}.")
    confirm_untouched(selection, "Selection")
    model, train_seconds = timed_fit(estimator or random_forest(cols.target), development(frame), cols)
    if claim is not None:
        claim_once(frame.sparkSession, claim, "Reserved test rows")
    started = time.perf_counter()
    scored = stage(
        predict(model, part(frame, TEST))
        .select(*cols.key, cols.target, "prediction", "lag_168")
        .withColumns(error_columns(cols.target)),
        "final-predictions",
    )
    predict_seconds = time.perf_counter() - started
    measured = scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.struct(*metric_columns(cols.target)).alias("random_forest"),
        F.struct(*metric_columns(cols.target, "lag_168")).alias("seasonal_naive"),
    )
    base, own = F.col("seasonal_naive.MAPE"), F.col("random_forest.MAPE")
    record = measured.select(
        F.lit(chosen).alias("selected_model"),
        F.lit("train_plus_validation").alias("training_scope"),
        development(frame).agg(F.count(F.lit(1)).alias("n")).scalar().alias("development_rows"),
        "test_rows",
        "random_forest",
        "seasonal_naive",
        (F.try_divide(base - own, base) * 100).alias("relative_mape_improvement_percent"),
        F.lit(train_seconds).alias("train_seconds"),
        F.lit(predict_seconds).alias("predict_seconds"),
        F.lit(True).alias("test_set_evaluated"),
    )
    return FinalEvaluation(model, scored.drop("lag_168"), record)
