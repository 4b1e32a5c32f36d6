"""Boosting that stops after a number of rounds without gain on the holdout rows.

Spark stops at the first round that does not lower the holdout error. Here rounds are fitted
without that, the holdout loss of every round is read off the model in one pass, and the rule
looks back ``patience`` rounds. A model with more rounds begins with the same trees, so more are
fitted until the rule stops or the most rounds are reached: all of them once the last round is
the best so far, else three times as many. With 300 rounds there are at most three fits, which
together are 1.4 times the work of all rounds. The model is then cut back to its best round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession

from .boosted_trees import BoostedTrees, boost_rows

# Rounds without gain, and what counts as one.
PATIENCE = 20
TOLERANCE = 1e-7
FIRST_ROUNDS = 30


@dataclass(frozen=True)
class Rounds:
    """``stopped``: the round after which the rule stops, None if it does not; ``best``: the one with the least loss."""

    stopped: int | None
    best: int


@dataclass(frozen=True)
class Boosted:
    model: GBTRegressionModel | BoostedTrees
    losses: list[float]
    rounds: Rounds

    def table(self, spark: SparkSession) -> DataFrame:
        """``round, loss, kept``: the curve up to where the rule stopped."""
        curve = self.losses[: self.rounds.stopped]
        rows = [(i, loss, i <= self.rounds.best) for i, loss in enumerate(curve, 1)]
        return spark.createDataFrame(rows, "round int, loss double, kept boolean")


def stopping_round(losses: Sequence[float], patience: int = PATIENCE, tolerance: float = TOLERANCE) -> Rounds:
    """Stop at the first round where none of the last ``patience`` losses is below the one before them.

    A loss has to be lower by more than ``tolerance``. Of equal least losses the earliest round is best.
    """
    if patience < 1:
        raise ValueError("patience must be positive")
    stopped = None
    for n in range(patience + 1, len(losses) + 1):
        if min(losses[n - patience : n]) >= losses[n - patience - 1] - tolerance:
            stopped = n
            break
    seen = losses[:stopped]
    return Rounds(stopped, 1 + min(range(len(seen)), key=seen.__getitem__, default=0))


def cut_back(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` trees."""
    if rounds >= len(model.trees):
        return model
    spark = SparkSession.active()
    gateway, package = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(package.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:rounds], model.treeWeights[:rounds], strict=True)):
        trees[i], weights[i] = tree, float(weight)
    java = package.GBTRegressionModel(model.uid, trees, weights)
    java.setFeaturesCol(model.getFeaturesCol())
    java.setPredictionCol(model.getPredictionCol())
    cut = GBTRegressionModel(java)
    cut._transfer_params_from_java()
    return cut


def next_rounds(rounds: int, most: int, best: int) -> int:
    """How many rounds to fit after ``rounds`` without a stop.

    Each fit starts anew. While the last round is the best, nothing says that the end is near.
    """
    return most if best == rounds or 4 * rounds >= most else 3 * rounds


def boost(
    regressor: GBTRegressor,
    train: DataFrame,
    holdout: DataFrame,
    patience: int = PATIENCE,
    tolerance: float = TOLERANCE,
    first_rounds: int = FIRST_ROUNDS,
) -> Boosted:
    """Rounds fitted on ``train`` until the loss on ``holdout`` says stop, cut back to the best.

    Both are read once for each fit: stage them. Without holdout rows all rounds are kept.
    """
    most = regressor.getMaxIter()
    rounds = min(most, max(first_rounds, patience + 1))
    held = not holdout.isEmpty()
    if not held:
        model = regressor.fit(train)
        return Boosted(model, [], Rounds(None, most))
    while True:
        model = regressor.copy({regressor.maxIter: rounds}).fit(train)
        losses = [float(v) for v in model.evaluateEachIteration(holdout, "squared")]
        if any(math.isnan(v) for v in losses):
            raise ValueError("the holdout loss is not a number")
        found = stopping_round(losses, patience, tolerance)
        if found.stopped or rounds == most:
            return Boosted(cut_back(model, found.best), losses, found)
        rounds = next_rounds(rounds, most, found.best)


def boost_many(
    regressor: GBTRegressor,
    rows: DataFrame,
    held: Column,
    patience: int = PATIENCE,
    tolerance: float = TOLERANCE,
    partitions: int | None = None,
) -> Boosted:
    """``boost`` for many rows, those ``held`` out among them: nothing is fitted anew, as the rule is asked in every round."""

    def stop(losses: Sequence[float]) -> int | None:
        if any(math.isnan(v) for v in losses[-1:]):
            raise ValueError("the holdout loss is not a number")
        return stopping_round(losses, patience, tolerance).stopped

    model, losses = boost_rows(regressor, rows, held, stop, partitions)
    if not losses:
        return Boosted(model, [], Rounds(None, regressor.getMaxIter()))
    found = stopping_round(losses, patience, tolerance)
    return Boosted(model.cut_back(found.best), losses, found)
