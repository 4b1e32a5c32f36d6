"""Was the threshold fitted without looking at the test rows?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import label
from ..schema import DEFAULT_COLUMNS, SeriesColumns

# What a record that lacks a flag is taken to say, and the status texts.
SAFE_DEFAULTS = {
    "calibration_model_training_scope": "train_only",
    "threshold_source": "unseen_validation_residuals",
    "validation_seen_by_calibration_model": False,
    "threshold_fit_on_final_test": False,
    "final_test_usage": "scoring_only",
}
REVIEW, SAFE = "REVIEW REQUIRED", "FROZEN · LEAKAGE SAFE"


def integrity_status(record: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Status texts for each run record."""

    def flag(name: str) -> Column:
        default = F.lit(SAFE_DEFAULTS[name])
        return F.coalesce(F.col(name), default) if name in record.columns else default

    seen, fitted = flag("validation_seen_by_calibration_model"), flag("threshold_fit_on_final_test")
    kept = [c for c in (cols.series,) if c in record.columns]
    return record.select(
        *kept,
        F.when(seen | fitted, REVIEW).otherwise(SAFE).alias("status"),
        F.upper(flag("calibration_model_training_scope")).alias("training_scope"),
        label(flag("threshold_source")).alias("threshold_source"),
        F.when(seen, REVIEW).otherwise("PREDICTION ONLY").alias("validation_role"),
        F.when(fitted, REVIEW).otherwise("TEST UNTOUCHED").alias("threshold_fitting"),
        label(flag("final_test_usage")).alias("final_test_usage"),
    )
