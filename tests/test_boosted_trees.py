from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from loadcast.operators import models
from loadcast.operators.boosted_trees import BoostedTrees, descend, is_plain
from loadcast.operators.boosting import boost, boost_many, stopping_round
from loadcast.operators.deep_forests import LEAF, feature_cuts, summed
from loadcast.operators.models import HOLDOUT, assembled, feature_importance, fit_model, gradient_boosting, predict
from loadcast.sources import load_model, save_model

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module", autouse=True)
def workers_find_the_library(spark):
    old = spark.sparkContext.environment.get("PYTHONPATH")
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).parents[1]), old]))


@pytest.fixture(scope="module")
def rows(spark):
    """A step in ``a``, a slope in ``b``, noise in ``c`` and the target; ``d`` is constant. Few values, so bins are clear."""
    path = spark.range(5000).select(
        F.lit("s").alias("series_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("double").alias("a"),
        F.pmod(F.xxhash64("id"), F.lit(40)).cast("double").alias("b"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(25)).cast("double").alias("c"),
        F.lit(1.0).alias("d"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 100).alias("noise"),
    )
    return path.withColumn("y", 100 * (F.col("a") > 1).cast("int") + F.sqrt("b") + F.col("noise")).localCheckpoint()


def boosting(**overrides):
    return gradient_boosting(features=FEATURES, **{"maxIter": 60, "maxDepth": 4, "maxBins": 64, **overrides})


def test_many_rows_are_not_fitted_anew(spark, rows, monkeypatch):
    """Spark ML fitted them, again from the start whenever the rule wanted more rounds."""
    pipeline = boosting(stepSize=0.4)
    vectors = assembled(pipeline, rows).localCheckpoint()
    held = vectors.where(HOLDOUT).drop(HOLDOUT)
    whole = boost(pipeline.getStages()[1], vectors.where(~F.col(HOLDOUT)).drop(HOLDOUT), held, 5, first_rounds=60)
    monkeypatch.setattr(models, "MANY_ROWS", 1000)
    monkeypatch.setattr(GBTRegressor, "fit", lambda *_: pytest.fail("fitted by Spark ML"))
    found = models.boosted(pipeline.getStages()[1], vectors, patience=5)
    assert isinstance(found.model, BoostedTrees) and found.rounds == whole.rounds == stopping_round(found.losses, 5)
    assert found.rounds.stopped == len(found.losses) < 60 and len(found.model.trees) == found.rounds.best
    assert np.allclose(found.losses, whole.losses[: len(found.losses)])
    a, b = ([r[0] for r in m.transform(held).select("prediction").collect()] for m in (found.model, whole.model))
    assert np.allclose(a, b)
    shares = found.model.featureImportances.toArray()
    assert np.allclose(shares[:3], whole.model.featureImportances.toArray()[:3], atol=1e-6) and shares[3] == 0


def test_rows_dealt_out_otherwise_make_the_same_trees(rows):
    pipeline = boosting(maxIter=12)
    regressor, vectors = pipeline.getStages()[1], assembled(pipeline, rows).localCheckpoint()
    one, many = (boost_many(regressor, vectors, F.col(HOLDOUT), partitions=n) for n in (1, 70))
    assert np.allclose(one.losses, many.losses) and len(one.losses) == 12


def test_without_holdout_rows_all_rounds(rows):
    pipeline = boosting(maxIter=3)
    vectors = assembled(pipeline, rows).withColumn(HOLDOUT, F.lit(False)).localCheckpoint()
    found = boost_many(pipeline.getStages()[1], vectors, F.col(HOLDOUT))
    assert len(found.model.trees) == 3 and found.losses == [] and found.rounds.stopped is None
    with pytest.raises(ValueError, match="needs rows"):
        boost_many(pipeline.getStages()[1], vectors.limit(0), F.col(HOLDOUT))
    with pytest.raises(Exception, match="Labels MUST NOT be Null or NaN"):
        boost_many(pipeline.getStages()[1], vectors.withColumn("y", F.when(F.rand(1) < 0.9, F.col("y"))), F.col(HOLDOUT))


def test_saved_and_loaded(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "MANY_ROWS", 1000)
    model = fit_model(boosting(maxIter=5), rows)
    loaded = load_model(spark, save_model(model, str(tmp_path / "boosted")))
    before, after = (predict(m, rows).orderBy("ts").select("prediction").collect() for m in (model, loaded))
    assert before == after and isinstance(loaded.stages[1], BoostedTrees)
    shares = feature_importance(loaded)
    assert shares.collect() == feature_importance(model).collect()
    assert shares.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    save_model(loaded, str(tmp_path / "again"))


def test_only_what_is_done_here():
    assert is_plain(gradient_boosting().getStages()[1])
    other = [{"lossType": "absolute"}, {"subsamplingRate": 0.5}, {"maxDepth": 9}, {"minInfoGain": 0.1}, {"weightCol": "w"}]
    for params in [*other, {"featureSubsetStrategy": "sqrt"}, {"validationIndicatorCol": "v"}, {"maxBins": 300}]:
        assert not is_plain(boosting(**params).getStages()[1])


def test_small_steps(spark):
    rng = np.random.default_rng(0)
    bins = rng.integers(0, 9, (3, 500)).astype(np.uint8)
    feature, cut = rng.integers(0, 3, 15).astype(np.uint8), rng.integers(0, 9, 15).astype(np.uint8)
    cut[5] = LEAF
    for levels in range(5):
        want = []
        for row in bins.T:
            node = 0
            for _ in range(levels):
                node = 2 * node + 1 + (row[feature[node]] > cut[node])
            want.append(node - (2**levels - 1))
        assert descend(bins, feature, cut, levels).tolist() == want
    at, y = rng.integers(0, 4, 500), rng.normal(size=500)
    for mine in (None, np.flatnonzero(at > 1)):
        chosen = np.arange(500) if mine is None else mine
        for f, found in enumerate(summed(bins, at, (None, y), [9, 9, 9], 4, mine)):
            for node, value in ((2, 4), (3, 8)):
                picked = chosen[(at[chosen] == node) & (bins[f, chosen] == value)]
                assert found[0, node, value] == len(picked) and found[1, node, value] == pytest.approx(y[picked].sum())
    # Cuts lie at even ranks; all values of a feature are known if they are few.
    known = spark.range(30_000).selectExpr("array(double(id), double(id % 3)) AS x").repartition(5)
    even, few = feature_cuts(known, 4)
    assert np.allclose(even, [7500, 15000, 22500], atol=12) and few == [0.5, 1.5]
