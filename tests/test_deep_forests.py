from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from loadcast.operators.deep_forests import DROP_SHUFFLES, DeepForest, assemble, copies, grow, grow_forest, is_deep, thresholds
from loadcast.operators.models import assembled, feature_importance, fit_model, predict, random_forest
from loadcast.sources import load_model, save_model

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module", autouse=True)
def workers_find_the_library(spark):
    old = spark.sparkContext.environment.get("PYTHONPATH")
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).parents[1]), old]))


@pytest.fixture(scope="module")
def rows(spark):
    """A step in ``a``, a slope in ``b`` of many values, noise in ``c``; rows come in threes."""
    path = spark.range(6000).select(
        F.lit("s").alias("series_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("double").alias("a"),
        (F.floor(F.col("id") / 3) * 0.37).alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(1000))).cast("double").alias("c"),
    )
    return path.withColumn("y", F.round(100 * (F.col("a") > 1).cast("int") + F.sqrt("b") + F.col("c") / 200, 3)).localCheckpoint()


def forest(**overrides):
    return random_forest(features=FEATURES, **{"numTrees": 4, "maxDepth": 14, **overrides})


def vectors(rows, **overrides):
    estimator = forest(**overrides)
    return estimator.getStages()[1], assembled(estimator, rows).drop("_holdout").localCheckpoint()


def scores(model, table):
    return np.array([r[0] for r in model.transform(table).select("prediction").collect()])


def test_a_deep_forest_keeps_no_bins_of_small_nodes(rows):
    """It was grown by Spark ML, with statistics of all bins for each node; a shallow one still is."""
    (deep,) = fit_model(forest(), rows).stages[1:]
    assert isinstance(deep, DeepForest) and deep.getNumTrees == 4
    shallow = fit_model(forest(maxDepth=5), rows).stages[1:]
    assert all(hasattr(s, "treeWeights") for s in shallow if hasattr(s, "getNumTrees"))
    assert is_deep(random_forest().getStages()[1])
    other = [{"subsamplingRate": 0.5}, {"featureSubsetStrategy": "sqrt"}, {"minInfoGain": 0.1}, {"bootstrap": False}]
    for params in [*other, {"weightCol": "w"}, {"minWeightFractionPerNode": 0.1}, {"maxBins": 300}]:
        assert not is_deep(forest(**params).getStages()[1])


def test_pieces_make_the_same_trees(spark, rows):
    """Nodes split by histograms of all tasks and nodes grown from their rows: the same splits."""
    regressor, table = vectors(rows)
    whole, cut = grow_forest(regressor, table), grow_forest(regressor, table, piece_rows=400)
    assert cut.table.count() > 4 * 10 and whole.table.count() == 8
    # Splits of equal gain, as of a node of few rows, are told apart by rounding.
    apart = np.abs(scores(whole, table) - scores(cut, table))
    assert (apart < 1e-9).mean() > 0.95 and apart.mean() < 0.001
    assert list(whole.featureImportances) == pytest.approx(list(cut.featureImportances), abs=1e-4)


def test_trees_are_shuffled_a_few_at_a_time(spark, rows):
    """Their shuffle files go when they are staged, and nothing else changes."""
    regressor, table = vectors(rows)
    before = spark.conf.get(DROP_SHUFFLES)
    together, apart = grow_forest(regressor, table), grow_forest(regressor, table, shuffled_rows=12_000)
    assert spark.conf.get(DROP_SHUFFLES) == before
    assert [len(t[0]) for t in together.trees] == [len(t[0]) for t in apart.trees] and len(apart.trees) == 4
    assert np.abs(scores(together, table) - scores(apart, table)).max() < 1e-9


def test_as_good_as_spark_ml(rows):
    regressor, table = vectors(rows, numTrees=10)
    deep, other = grow_forest(regressor, table), regressor.fit(table)
    target = np.array([r[0] for r in table.select("y").collect()])
    errors = [np.abs(scores(m, table) - target).mean() for m in (deep, other)]
    assert errors[0] < 1.1 * errors[1]
    assert list(deep.featureImportances) == pytest.approx(list(other.featureImportances), abs=0.01)
    # Array 1 has the cuts; the root is there twice.
    sizes = sum(2 * (t[1] < 255).sum() - 1 for t in deep.trees), sum(t.numNodes for t in other.trees)
    assert sizes[0] == pytest.approx(sizes[1], rel=0.05)


def test_a_large_node_without_a_split_is_a_leaf(spark):
    rows = spark.range(500).select(
        F.lit("s").alias("series_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
        F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.lit(3.0).alias("c"), F.lit(0.1).alias("y"),
    ).localCheckpoint()
    regressor, table = vectors(rows)
    for found in (grow_forest(regressor, table), grow_forest(regressor, table, piece_rows=100)):
        assert set(scores(found, table)) == {0.1}
        assert not found.featureImportances.toArray().any()


def test_odd_rows(spark, rows):
    regressor, table = vectors(rows)
    with pytest.raises(ValueError, match="needs rows"):
        grow_forest(regressor, table.limit(0))
    with pytest.raises(Exception, match="Labels MUST NOT be Null or NaN"):
        grow_forest(regressor, table.withColumn("y", F.when(F.rand(1) < 0.9, F.col("y"))))
    one = grow_forest(regressor, table.limit(1).localCheckpoint())
    assert one.getNumTrees == 4


def test_saved_and_loaded(spark, rows, tmp_path):
    model = fit_model(forest(), rows)
    loaded = load_model(spark, save_model(model, str(tmp_path / "deep")))
    assert isinstance(loaded, PipelineModel) and loaded.stages[1].uid == model.stages[1].uid
    before, after = (predict(m, rows).orderBy("ts").select("prediction").collect() for m in (model, loaded))
    assert before == after
    shares = feature_importance(loaded)
    assert shares.collect() == feature_importance(model).collect()
    assert shares.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    save_model(loaded, str(tmp_path / "deep2"))


def test_small_steps():
    assert thresholds([1.0, 1.0, 2.0, 4.0], 128) == [1.5, 3.0]
    assert thresholds([5.0, 5.0], 128) == []
    many = thresholds(list(range(1001)), 8)
    assert len(many) == 7 and many[3] == 500.5
    drawn = copies(np.arange(200_000), 3, 42)
    assert abs(drawn.mean() - 1) < 0.01 and abs(drawn.var() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(drawn, copies(np.arange(200_000), 4, 42))[0, 1]) < 0.01
    bins = np.array([[0, 0, 1, 1]], np.uint8)
    feature, cut, left, value, gains = grow(bins, np.array([0.0, 0, 4, 4]), np.array([1, 1, 1, 1], np.uint8), [2], 5, 2)
    assert (cut.tolist(), left.tolist(), value.tolist(), gains.tolist()) == ([0, 255, 255], [1, 1, 2], [2, 0, 4], [16])
    assert len(grow(bins, np.array([0.0, 0, 4, 4]), np.ones(4, np.uint8), [2], 5, 3)[0]) == 1
    blobs = {"feature": feature.tobytes(), "cut": cut.tobytes(), "left": left.tobytes(), "value": value.tobytes()}
    top = {"feature": b"\0", "cut": b"\xff", "left": np.zeros(1, np.int32).tobytes(), "value": np.zeros(1).tobytes()}
    ((_, cut, left, value),) = assemble([{"tree": 0, "node": -1, **top}, {"tree": 0, "node": 0, **blobs}])
    assert left[0] == 2 and value[left[0]] == 0 and value[left[0] + 1] == 4 and left[left[0]] == left[0]
