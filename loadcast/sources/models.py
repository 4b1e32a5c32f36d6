"""Fitted models as Spark ML directories."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from .records import require_paths


def save_model(model: PipelineModel, path: str) -> str:
    """Write the model, replacing an earlier one; parent folders are made."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    try:
        require_paths(spark, [f"{path}/metadata"])
    except FileNotFoundError as error:
        raise FileNotFoundError(f"Model file not found: {path}") from error
    return PipelineModel.load(path)
