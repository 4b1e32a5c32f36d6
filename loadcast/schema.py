"""Column names, table schemas and the guards every public function shares."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SeriesColumns:
    """Which columns hold the series key, the time axis and the observed value."""

    series: str = "series_id"
    time: str = "ts"
    target: str = "y"

    @property
    def key(self) -> list[str]:
        return [self.series, self.time]

    @property
    def chronological(self) -> Column:
        """Sort key of the time axis; unknown times come last."""
        return F.col(self.time).asc_nulls_last()


DEFAULT_COLUMNS = SeriesColumns()
# The folders of a table stored by day; a name that no column of a source has by chance.
DAY = "_day"

# The feature set every model is trained on.
CALENDAR_COLUMNS = ["hour", "day_of_week", "month", "day_of_year", "is_weekend"]
HISTORY_COLUMNS = [
    "lag_24",
    "lag_48",
    "lag_168",
    "rolling_mean_24",
    "rolling_std_24",
    "rolling_mean_168",
]
FEATURE_COLUMNS = CALENDAR_COLUMNS + HISTORY_COLUMNS

# Split names, model names, anomaly grades.
TRAIN, VALIDATION, TEST = "train", "validation", "test"
SEASONAL_NAIVE = "Seasonal Naive"
RANDOM_FOREST = "Random Forest"
GRADIENT_BOOSTING = "HistGradientBoosting"
CANDIDATE_MODELS = [RANDOM_FOREST, GRADIENT_BOOSTING]
SEVERITY_LEVELS = ["moderate", "high", "critical"]
DIRECTIONS = ["spike", "drop"]


def predictions_schema(cols: SeriesColumns = DEFAULT_COLUMNS) -> T.StructType:
    return T.StructType(
        [
            T.StructField(cols.series, T.StringType()),
            T.StructField(cols.time, T.TimestampNTZType()),
            T.StructField(cols.target, T.DoubleType()),
            T.StructField("prediction", T.DoubleType()),
            T.StructField("residual", T.DoubleType()),
            T.StructField("absolute_error", T.DoubleType()),
        ]
    )


def anomalies_schema(cols: SeriesColumns = DEFAULT_COLUMNS) -> T.StructType:
    return T.StructType(
        [
            T.StructField(cols.series, T.StringType()),
            T.StructField(cols.time, T.TimestampNTZType()),
            T.StructField(cols.target, T.DoubleType()),
            T.StructField("prediction", T.DoubleType()),
            T.StructField("residual", T.DoubleType()),
            T.StructField("absolute_residual", T.DoubleType()),
            T.StructField("is_anomaly", T.BooleanType()),
            T.StructField("severity_score", T.DoubleType()),
            T.StructField("direction", T.StringType()),
            T.StructField("severity", T.StringType()),
        ]
    )


BACKTEST_SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("RMSE", T.DoubleType()),
        T.StructField("MAPE", T.DoubleType()),
        T.StructField("train_seconds", T.DoubleType()),
        T.StructField("predict_seconds", T.DoubleType()),
    ]
)

COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("RMSE", T.DoubleType()),
        T.StructField("MAPE", T.DoubleType()),
        T.StructField("train_seconds", T.DoubleType()),
        T.StructField("predict_seconds", T.DoubleType()),
    ]
)

IMPORTANCE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType()),
    ]
)


def require_columns(
    df: DataFrame, required: Sequence[str], what: str = "required columns", *, keep_order: bool = False
) -> None:
    """Fail at plan time, without a job, when columns are absent."""
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    if missing:
        shown = missing if keep_order else sorted(missing)
        raise ValueError(f"Missing {what}: {shown}")


def require_between(name: str, value: float, low: float = 0.0, high: float = 1.0) -> None:
    if not low < value < high:
        raise ValueError(f"{name} must be between {low:g} and {high:g}")


def require_positive(name: str, value: float) -> None:
    if value != value or value in (float("inf"), float("-inf")):
        raise ValueError(f"{name} must be finite and positive")
    if value <= 0:
        raise ValueError(f"{name} must be positive (greater than 0)")


def without(columns: Iterable[str], drop: Iterable[str]) -> list[str]:
    dropped = set(drop)
    return [name for name in columns if name not in dropped]
