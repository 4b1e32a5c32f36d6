"""Forests as several smaller ones, fitted at once and averaged into one scorer.

Spark grows all trees of a forest together, and every partition keeps the statistics of every
open node of every tree: a deep forest on many partitions mostly moves statistics. Trees do not
need each other. Where the rows leave cores idle, the forest is fitted as several smaller
forests, in jobs that run side by side on as few partitions as the rows need. With rows enough
to keep all cores busy it is one forest on all partitions, as Spark fits it.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from .deep_forests import grow_forest, is_deep

# Rows that one task trains on. Below it a further partition costs statistics and saves little time.
ROWS_PER_TASK = 500_000
# Forests fitted at once: each has its own passes, which the driver plans.
MAX_PARTS = 32


@dataclass(frozen=True)
class ForestPlan:
    """How many partitions the rows take, and how many trees each of the forests has."""

    partitions: int
    trees: list[int]


def plan_forest(rows: int, cores: int, trees: int, rows_per_task: int = ROWS_PER_TASK) -> ForestPlan:
    """Partitions by the rows alone; forests by the cores that these leave idle."""
    partitions = max(1, -(-rows // rows_per_task))
    parts = max(1, min(cores // partitions, trees, MAX_PARTS))
    return ForestPlan(partitions, [trees // parts + (i < trees % parts) for i in range(parts)])


def dealt(rows: DataFrame, partitions: int) -> DataFrame:
    """``rows`` in so many partitions: merged if there are more, else dealt out evenly by a shuffle.

    Files are read in as many parts as their bytes make, which are few and uneven: trees are grown
    from rows that a task holds as objects, so a task's share has to follow the rows.
    """
    if partitions <= rows.rdd.getNumPartitions():
        return rows.coalesce(partitions)
    return rows.repartition(partitions)


def plan_rounds(rows: int, cores: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for trees that follow each other: a share of few rows, full waves over the cores of many."""
    if rows <= rows_per_task:
        return max(1, -(-rows * cores // rows_per_task))
    return cores * -(-rows // (cores * rows_per_task))


def fit_forest(regressor: RandomForestRegressor, rows: DataFrame, partitions: int | None = None) -> list[Transformer]:
    """The fitted stages that score a row: one forest, or several and their mean.

    ``rows`` are staged: they are counted, and every forest reads them. Each forest draws its own
    samples, the first with the regressor's seed. The mean weighs a forest by its trees, so it is
    the mean over all trees. A deep forest is grown by other means (``deep_forests``).
    """
    if is_deep(regressor):
        return [grow_forest(regressor, rows)]
    context = rows.sparkSession.sparkContext
    plan = plan_forest(rows.count(), context.defaultParallelism, regressor.getNumTrees())
    merged = dealt(rows, partitions or plan.partitions)
    if len(plan.trees) == 1:
        return [regressor.fit(merged)]
    output = regressor.getPredictionCol()

    def fit(i: int) -> Transformer:
        own = {regressor.numTrees: plan.trees[i], regressor.seed: regressor.getSeed() + i}
        return regressor.copy({**own, regressor.predictionCol: f"_forest_{i}"}).fit(merged)

    with ThreadPool(len(plan.trees)) as pool:
        forests = pool.map(inheritable_thread_target(rows.sparkSession)(fit), range(len(plan.trees)))
    names = [f.getPredictionCol() for f in forests]
    total = " + ".join(f"{n} * {name}" for n, name in zip(plan.trees, names, strict=True))
    statement = f"SELECT * EXCEPT ({', '.join(names)}), ({total}) / {sum(plan.trees)} AS {output} FROM __THIS__"
    return [*forests, SQLTransformer(statement=statement)]


def forest_importance(model: PipelineModel) -> list[float]:
    """The importance of each feature, as the mean over all trees of all forests or of the boosting."""
    parts = [(s.getNumTrees, s.featureImportances.toArray()) for s in model.stages if hasattr(s, "featureImportances")]
    summed = sum(n * values for n, values in parts)
    return (summed / summed.sum() if summed.sum() > 0 else summed).tolist()
