"""Chronological split and expanding backtest folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.errors import cut_index
from ..schema import (
    DEFAULT_COLUMNS,
    FEATURE_COLUMNS,
    TEST,
    TRAIN,
    VALIDATION,
    SeriesColumns,
    require_between,
    require_positive,
)
from .layout import Layout
from .ordering import number_rows

# Split ratios and backtest shape.
TRAIN_RATIO, VALIDATION_RATIO = 0.70, 0.15
N_FOLDS, MIN_TRAIN_FRACTION = 4, 0.50


def complete_cases(df: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows with every feature and the target present. Positions must be taken after this."""
    return df.dropna(subset=[*FEATURE_COLUMNS, cols.target])


def split_column(rn: Column, n_rows: Column, train_ratio: float, validation_ratio: float) -> Column:
    train_end = cut_index(n_rows, train_ratio)
    validation_end = train_end + cut_index(n_rows, validation_ratio)
    return F.when(rn < train_end, TRAIN).when(rn < validation_end, VALIDATION).otherwise(TEST)


def chronological_split(
    df: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    train_ratio: float = TRAIN_RATIO,
    validation_ratio: float = VALIDATION_RATIO,
    layout: Layout | None = None,
) -> DataFrame:
    """Tag each row ``train``, ``validation`` or ``test`` by its position in its series.

    One tagged table instead of three copies; take a part with ``part``.
    """
    require_between("train_ratio", train_ratio)
    require_between("val_ratio", validation_ratio)
    if train_ratio + validation_ratio >= 1:
        raise ValueError("train_ratio + val_ratio must be less than 1")
    if cols.time not in df.columns:
        raise ValueError(f"Missing required column: {cols.time}")
    numbered = number_rows(df, cols, layout)
    tag = split_column(F.col("rn"), F.col("n_rows"), train_ratio, validation_ratio)
    return numbered.withColumn("split", tag)


def part(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("split").isin(list(names)))


def development(df: DataFrame) -> DataFrame:
    """Train and validation rows together, as one bag; the test rows stay out."""
    return part(df, TRAIN, VALIDATION)


def development_rows(
    n_rows: Column, train_ratio: float = TRAIN_RATIO, validation_ratio: float = VALIDATION_RATIO
) -> Column:
    return cut_index(n_rows, train_ratio) + cut_index(n_rows, validation_ratio)


def _fold_shape(n: Column, n_folds: int, min_train_fraction: float, strict: bool) -> tuple[Column, Column]:
    """Where the first fold begins and how long a fold is; NULL for a series too short for all folds."""
    first = cut_index(n, min_train_fraction)
    size = F.floor((n - first) / F.lit(n_folds)).cast("bigint")
    failure = F.raise_error(F.lit("Not enough rows to create the folds")) if strict else F.lit(None)
    return first, F.when(size > 0, size).otherwise(failure.cast("bigint"))


def validation_fold(
    df: DataFrame,
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
    rn: str = "rn",
    count: str = "n_development",
    strict: bool = False,
) -> DataFrame:
    """Add ``fold``, the one fold a development row validates; NULL in the first training stretch.

    Pure arithmetic on the position: no join, no copies, no shuffle. A series with too
    few rows for the folds has none, which ``strict`` turns into a failure of the job.
    """
    require_positive("n_folds", n_folds)
    first, size = _fold_shape(F.col(count), n_folds, min_train_fraction, strict)
    number = F.least(F.lit(n_folds), F.floor((F.col(rn) - first) / size) + 1).cast("int")
    return df.withColumn("fold", F.when(size.isNotNull() & (F.col(rn) >= first), number))


def fold_bounds(
    series: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
    count: str = "n_development",
    strict: bool = False,
) -> DataFrame:
    """``(series, fold, train_end, validation_end)`` from one row per series.

    A series with too few rows keeps its rows with both ends unknown.
    """
    require_positive("n_folds", n_folds)
    first, size = _fold_shape(F.col(count), n_folds, min_train_fraction, strict)
    fold = F.col("fold")
    end = F.when(size.isNull(), F.lit(None)).when(fold == n_folds, F.col(count)).otherwise(first + fold * size)
    return series.select(
        cols.series, count, F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold")
    ).select(cols.series, "fold", (first + (fold - 1) * size).alias("train_end"), end.alias("validation_end"))


def expanding_folds(
    df: DataFrame,
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
    rn: str = "rn",
    count: str = "n_development",
    strict: bool = False,
) -> DataFrame:
    """Every (row, fold) membership with its ``role``.

    A row validates at most one fold and trains all later ones, so its folds are
    a range worked out from its own position: an explode, not a join. Rows of a series
    that is too short for the folds are in none; ``strict`` fails instead.
    """
    placed = validation_fold(df, n_folds, min_train_fraction, rn, count, strict)
    _, size = _fold_shape(F.col(count), n_folds, min_train_fraction, strict)
    validated = F.col("_validated")
    folds = F.sequence(F.coalesce(validated, F.lit(1)), F.lit(n_folds))
    return (
        placed.withColumnRenamed("fold", "_validated")
        .withColumn("fold", F.explode(F.when(size.isNotNull(), folds)))
        .withColumn("role", F.when(F.col("fold") == validated, VALIDATION).otherwise(TRAIN))
        .drop("_validated")
    )
