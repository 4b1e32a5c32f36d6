"""Diagnose a fitted model on the validation rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.errors import absolute_percentage_error, error_columns
from ..operators.metrics import residual_diagnostics
from ..operators.models import feature_importance, timed_predict
from ..operators.ranking import worst_errors
from ..operators.split import part
from ..schema import DEFAULT_COLUMNS, VALIDATION, SeriesColumns


@dataclass(frozen=True)
class Diagnostics:
    rows: DataFrame
    importance: DataFrame
    worst: DataFrame
    record: DataFrame


def analyze(frame: DataFrame, model: PipelineModel, cols: SeriesColumns = DEFAULT_COLUMNS, k: int = 10) -> Diagnostics:
    scored, _ = timed_predict(model, part(frame, VALIDATION), cols)
    rows = scored.withColumns(
        {
            **error_columns(cols.target),
            "absolute_percentage_error": absolute_percentage_error(F.col(cols.target), F.col("prediction")),
        }
    )
    record = (
        residual_diagnostics(rows, (), cols.target)
        .withColumnRenamed("rows", "validation_rows")
        .withColumn("test_set_evaluated", F.lit(False))
    )
    return Diagnostics(rows, feature_importance(model), worst_errors(rows, k, (), cols), record)
