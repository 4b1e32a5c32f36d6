"""Forecast models as Spark ML pipelines over the feature columns."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CALENDAR_COLUMNS, DEFAULT_COLUMNS, FEATURE_COLUMNS, SeriesColumns
from ..session import stage
from .boosted_trees import MANY_ROWS, is_plain
from .boosting import PATIENCE, Boosted, boost, boost_many
from .forests import dealt, fit_forest, forest_importance, plan_rounds

VECTOR = "_features"
HOLDOUT = "_holdout"

# The frozen model configurations.
SEED = 42
FOREST = {"numTrees": 100, "maxDepth": 18, "minInstancesPerNode": 2}
CALENDAR_FOREST = {"numTrees": 100, "maxDepth": 30, "minInstancesPerNode": 1}
BOOSTING = {"stepSize": 0.08, "maxIter": 300, "maxDepth": 5, "minInstancesPerNode": 20}
HOLDOUT_FRACTION = 0.1

# Fixed value: split candidates per feature, for forests and boosting alike. With a forest on as few
# partitions as its rows need, more of them cost next to nothing (README has seconds and errors).
MAX_BINS = 128

# Node statistics kept per pass. The default of 256 MB makes a deep forest take
# several times as many passes over the data.
NODE_MEMORY_MB = 1024


def _pipeline(features: Sequence[str], regressor: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=VECTOR), regressor])


def random_forest(
    target: str = DEFAULT_COLUMNS.target, features: Sequence[str] = FEATURE_COLUMNS, seed: int = SEED, **overrides: object
) -> Pipeline:
    """The candidate forest. Every split considers all features; candidates are binned."""
    params = {
        "maxBins": MAX_BINS,
        "featureSubsetStrategy": "all",
        "maxMemoryInMB": NODE_MEMORY_MB,
        "seed": seed,
        **FOREST,
        **overrides,
    }
    return _pipeline(features, RandomForestRegressor(featuresCol=VECTOR, labelCol=target, predictionCol="prediction", **params))


def calendar_forest(target: str = DEFAULT_COLUMNS.target, seed: int = SEED, **overrides: object) -> Pipeline:
    """A forest on the calendar fields alone, as deep as Spark allows."""
    return random_forest(target, CALENDAR_COLUMNS, seed, **{**CALENDAR_FOREST, **overrides})


def gradient_boosting(
    target: str = DEFAULT_COLUMNS.target, features: Sequence[str] = FEATURE_COLUMNS, seed: int = SEED, **overrides: object
) -> Pipeline:
    """The challenger. ``fit_model`` stops it by its loss on a holdout tenth of the rows."""
    params = {
        "maxBins": MAX_BINS,
        "maxMemoryInMB": NODE_MEMORY_MB,
        "seed": seed,
        **BOOSTING,
        **overrides,
    }
    return _pipeline(features, GBTRegressor(featuresCol=VECTOR, labelCol=target, predictionCol="prediction", **params))


def holdout_flag(cols: SeriesColumns = DEFAULT_COLUMNS, fraction: float = HOLDOUT_FRACTION, seed: int = SEED) -> Column:
    """A fixed pseudo-random tenth of the rows, whatever the partitioning."""
    slots = 1_000_000
    return F.pmod(F.xxhash64(*cols.key, F.lit(seed)), F.lit(slots)) < int(slots * fraction)


def assembled(
    estimator: Pipeline, rows: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """What a fit reads: the feature vector, the target, the holdout mark, and the columns to keep."""
    assembler, regressor = estimator.getStages()
    features = assembler.getInputCols()
    missing = [c for c in features if c not in rows.columns]
    if missing:
        raise ValueError(f"Missing feature columns: {missing}")
    target = regressor.getLabelCol()
    if target not in rows.columns:
        raise ValueError(f"Missing target column: {target}")
    held = F.lit(False)
    if isinstance(regressor, GBTRegressor):
        held = holdout_flag(cols)
    return assembler.transform(rows).select(*keep, VECTOR, target, held.alias(HOLDOUT))


def fit_vectors(
    regressor: Estimator, vectors: DataFrame, partitions: int | None = None, patience: int = PATIENCE
) -> PipelineModel:
    """Train on a staged table of ``assembled`` rows. The result scores rows with a vector."""
    if isinstance(regressor, GBTRegressor):
        return PipelineModel([boosted(regressor, vectors, partitions, patience).model])
    return PipelineModel(fit_forest(regressor, vectors.drop(HOLDOUT), partitions))


def boosted(
    regressor: GBTRegressor, vectors: DataFrame, partitions: int | None = None, patience: int = PATIENCE
) -> Boosted:
    """Boosting on a staged table of ``assembled`` rows, with its holdout losses.

    Rounds follow each other, so only rows can be dealt out: a partition for each core, fewer
    if the rows are few, several of bounded size if they are many. Many rows are boosted by other
    means (``boosted_trees``).
    """
    cores, rows = vectors.sparkSession.sparkContext.defaultParallelism, vectors.count()
    if rows >= MANY_ROWS and is_plain(regressor):
        return boost_many(regressor, vectors, F.col(HOLDOUT), patience, partitions=partitions)
    merged = dealt(vectors, partitions or plan_rounds(rows, cores))
    train, held = (merged.where(c).drop(HOLDOUT) for c in (~F.col(HOLDOUT), F.col(HOLDOUT)))
    return boost(regressor, train, held, patience)


def fit_model(
    estimator: Pipeline,
    rows: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    partitions: int | None = None,
    patience: int = PATIENCE,
) -> PipelineModel:
    """Train on all the given rows, over every series. Pass only rows the model may see.

    The vectors are written once; every pass of every job reads them. The number of partitions
    follows the rows and the cores unless ``partitions`` names one. Boosting stops after
    ``patience`` rounds without a lower loss on its holdout rows.
    """
    assembler, regressor = estimator.getStages()
    vectors = stage(assembled(estimator, rows, cols), "vectors")
    return PipelineModel([assembler, *fit_vectors(regressor, vectors, partitions, patience).stages])


def predict(model: Model, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """One prediction per row, next to the row's own columns."""
    return model.transform(rows).drop(VECTOR).withColumnRenamed("prediction", name)


def feature_importance(model: PipelineModel) -> DataFrame:
    """``(feature, importance)``, largest first. The model holds one number per feature."""
    pairs = zip(model.stages[0].getInputCols(), forest_importance(model))
    table = SparkSession.active().createDataFrame(list(pairs), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def importance_view(table: DataFrame) -> DataFrame:
    """A stored importance table for display: incomplete rows left out, smallest first."""
    return table.select("feature", "importance").dropna().orderBy("importance", "feature")


def timed_fit(
    estimator: Pipeline, rows: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, partitions: int | None = None
) -> tuple[PipelineModel, float]:
    started = time.perf_counter()
    model = fit_model(estimator, rows, cols, partitions)
    return model, time.perf_counter() - started


def timed_predict(
    model: Model, rows: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS
) -> tuple[DataFrame, float]:
    """Predictions and the time it took to compute them.

    The rows are scored once, into a staged table, so that the time is that of
    the real work and every later reader uses the same numbers.
    """
    wanted = predict(model, rows).select(*cols.key, cols.target, "prediction")
    started = time.perf_counter()
    scored = stage(wanted, "predictions")
    return scored, time.perf_counter() - started
