"""Backtest on expanding windows of the development rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import backtest_summary, error_metrics
from ..operators.models import assembled, fit_vectors, gradient_boosting, random_forest, timed_predict
from ..operators.ranking import rank_models
from ..operators.split import (
    MIN_TRAIN_FRACTION,
    N_FOLDS,
    development,
    validation_fold,
)
from ..schema import (
    DEFAULT_COLUMNS,
    GRADIENT_BOOSTING,
    RANDOM_FOREST,
    SEASONAL_NAIVE,
    TEST,
    SeriesColumns,
)
from ..session import stage
from .comparison import as_model


def fold_metrics(
    predictions: DataFrame, by: Sequence[str] = (), cols: SeriesColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Metrics per fold and model, in one job for all folds.

    For predictors that need no fitting their times are zero.
    """
    measured = error_metrics(predictions.where(F.col("fold").isNotNull()), [*by, "fold", "model"], cols.target)
    return measured.withColumns({"train_seconds": F.lit(0.0), "predict_seconds": F.lit(0.0)})


@dataclass(frozen=True)
class Backtest:
    results: DataFrame
    summary: DataFrame
    record: DataFrame


def backtest_record(
    results: DataFrame,
    frame: DataFrame,
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
) -> DataFrame:
    """One record: winner by mean MAPE, mean and sample deviation per model, row counts."""
    ranked = rank_models(backtest_summary(results), ["MAPE_mean"])
    winner = ranked.agg(
        F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("winner_by_mean_mape"),
        F.map_from_entries(F.collect_list(F.struct("model", "MAPE_mean"))).alias("mean_mape_by_model"),
        F.map_from_entries(F.collect_list(F.struct("model", "MAPE_std"))).alias("mape_std_by_model"),
    )
    counts = frame.agg(
        F.count_if(F.col("split") != TEST).alias("development_rows"),
        F.count_if(F.col("split") == TEST).alias("reserved_test_rows"),
    )
    return counts.select(
        F.lit(n_folds).alias("n_folds"),
        F.lit(min_train_fraction).alias("min_train_fraction"),
        "development_rows",
        "reserved_test_rows",
        *[winner.select(c).scalar().alias(c) for c in winner.columns],
        F.lit(False).alias("test_set_evaluated"),
    )


def fold_vectors(
    placed: DataFrame,
    pipelines: Mapping[str, Pipeline],
    reads: Mapping[str, tuple[tuple[str, ...], bool]],
    cols: SeriesColumns = DEFAULT_COLUMNS,
) -> dict[tuple[str, ...], DataFrame]:
    """A staged vector table for each set of features, in folders by ``fold``; 0 trains every fold."""
    rows = placed.withColumn("fold", F.coalesce("fold", F.lit(0)))
    out = {}
    # One with a holdout mark serves those that do not read it, too.
    for name, (features, _) in sorted(reads.items(), key=lambda item: not item[1][1]):
        if features not in out:
            table = assembled(pipelines[name], rows, cols, [*cols.key, "fold"])
            out[features] = stage(table, "fold-vectors", ["fold"])
    return out


def backtest(
    frame: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    estimators: Mapping[str, Callable[[], Pipeline]] | None = None,
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
    parallelism: int = 1,
) -> Backtest:
    """Fit every estimator on each fold's past and measure it on the fold.

    The fold of a row is arithmetic on its position. Features are assembled once, into a vector
    table with a folder for each fold (0 for rows that only train), whatever the number of folds
    and estimators: a fit reads the folders before its fold, its scoring the fold's own.
    Only metric rows, one per fold and model, are gathered. With ``parallelism``
    several fits are submitted at once, and their recorded times overlap.
    """
    if estimators is None:
        estimators = {
            RANDOM_FOREST: lambda: random_forest(cols.target),
            GRADIENT_BOOSTING: lambda: gradient_boosting(cols.target),
        }
    rows = development(frame)
    placed = validation_fold(rows, n_folds, min_train_fraction)
    results = fold_metrics(as_model(placed, SEASONAL_NAIVE, "lag_168", cols), (), cols)

    pipelines = {name: make() for name, make in estimators.items()}
    # Estimators that read the same features, holdout mark included, share one table.
    reads = {
        name: (tuple(p.getStages()[0].getInputCols()), isinstance(p.getStages()[1], GBTRegressor))
        for name, p in pipelines.items()
    }
    tables = fold_vectors(placed, pipelines, reads, cols)

    def measure(task: tuple[int, str]) -> DataFrame:
        fold, name = task
        table = tables[reads[name][0]]
        started = time.perf_counter()
        past = table.where(F.col("fold") < fold).drop("fold")
        model = fit_vectors(pipelines[name].getStages()[1], past)
        train_seconds = time.perf_counter() - started
        scored, predict_seconds = timed_predict(model, table.where(F.col("fold") == fold), cols)
        return error_metrics(scored, (), cols.target).select(
            F.lit(fold).alias("fold"),
            F.lit(name).alias("model"),
            "MAE",
            "RMSE",
            "MAPE",
            F.lit(train_seconds).alias("train_seconds"),
            F.lit(predict_seconds).alias("predict_seconds"),
        )

    tasks = [(fold, name) for fold in range(1, n_folds + 1) for name in estimators]
    with ThreadPool(max(1, parallelism)) as pool:
        for measured in pool.map(inheritable_thread_target(frame.sparkSession)(measure), tasks):
            results = results.unionByName(measured)
    results = stage(results.coalesce(1), "backtest")
    return Backtest(
        results, backtest_summary(results), backtest_record(results, frame, n_folds, min_train_fraction)
    )


def fold_row_counts(
    rows: DataFrame,
    by: Sequence[str] = (),
    n_folds: int = N_FOLDS,
    min_train_fraction: float = MIN_TRAIN_FRACTION,
) -> DataFrame:
    """Train and validation rows of every fold, counted without copying a row into its folds."""
    fold = F.col("fold")
    counts = [
        F.struct(
            F.lit(f).alias("fold"),
            F.count_if(fold.isNull() | (fold < f)).alias("train_rows"),
            F.count_if(fold == f).alias("validation_rows"),
        )
        for f in range(1, n_folds + 1)
    ]
    placed = validation_fold(rows, n_folds, min_train_fraction)
    return placed.groupBy(*by).agg(F.array(*counts).alias("_folds")).select(*by, F.inline("_folds"))
