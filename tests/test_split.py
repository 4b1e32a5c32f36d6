from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.functions import cut_index
from loadcast.operators.split import (
    chronological_split,
    development,
    expanding_folds,
    fold_bounds,
    part,
    validation_fold,
)


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("n,want", [(100, (70, 15, 15)), (101, (70, 15, 16)), (340, (237, 51, 52))])
def test_sizes(hourly, n, want):
    found = sizes(chronological_split(hourly(range(n))))
    assert (found["train"], found["validation"], found["test"]) == want


def test_published_row_counts(spark):
    row = spark.range(1).select(
        cut_index(F.lit(121078), 0.70).alias("train"), cut_index(F.lit(121078), 0.15).alias("validation")
    ).first()
    assert tuple(row) == (84754, 18161)


def test_order_holds_for_shuffled_input(hourly):
    found = chronological_split(hourly(range(100)).orderBy(F.rand(3)))
    bounds = {r["split"]: (r["low"], r["high"]) for r in found.groupBy("split").agg(F.min("ts").alias("low"), F.max("ts").alias("high")).collect()}
    assert bounds["train"][1] < bounds["validation"][0] and bounds["validation"][1] < bounds["test"][0]
    assert found.count() == 100 and found.select("ts").distinct().count() == 100


@pytest.mark.parametrize("train,validation", [(0.9, 0.2), (0, 0.1), (1, 0.1), (0.5, 0), (0.5, 0.5)])
def test_bad_ratios(hourly, train, validation):
    with pytest.raises(ValueError):
        chronological_split(hourly(range(3)), train_ratio=train, validation_ratio=validation)


def test_missing_time(spark):
    with pytest.raises(ValueError, match="Missing required column: ts"):
        chronological_split(spark.createDataFrame([(1.0,)], "y double"))


def folds(hourly, n):
    return hourly(range(n)).withColumn("rn", F.col("y").cast("bigint")).withColumn("n_development", F.lit(n).cast("bigint"))


def test_folds_expand_and_the_last_one_takes_the_rest(hourly, spark):
    n = 103
    bounds = fold_bounds(spark.createDataFrame([("all", n)], "series_id string, n_development bigint")).orderBy("fold")
    assert [tuple(r)[1:] for r in bounds.collect()] == [(1, 51, 64), (2, 64, 77), (3, 77, 90), (4, 90, 103)]
    member = expanding_folds(folds(hourly, n)).groupBy("fold", "role").agg(
        F.min("rn").alias("low"), F.max("rn").alias("high"), F.count("*").alias("n")
    )
    found = {(r["fold"], r["role"]): (r["low"], r["high"], r["n"]) for r in member.collect()}
    for number, start, end in ((1, 51, 64), (2, 64, 77), (3, 77, 90), (4, 90, 103)):
        assert found[(number, "train")] == (0, start - 1, start)
        assert found[(number, "validation")] == (start, end - 1, end - start)


def test_fold_of_a_row_needs_no_shuffle(hourly):
    shown = validation_fold(folds(hourly, 50))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown and "Join" not in shown


def test_published_fold_sizes(spark):
    rows = fold_bounds(spark.createDataFrame([("all", 102915)], "series_id string, n_development bigint")).collect()
    assert [r["validation_end"] - r["train_end"] for r in sorted(rows)] == [12864, 12864, 12864, 12866]
    assert min(r["train_end"] for r in rows) == 51457


def test_too_few_rows_for_folds(hourly):
    with pytest.raises(PySparkException, match="Not enough rows"):
        validation_fold(folds(hourly, 5), strict=True).collect()


def test_a_short_series_does_not_stop_the_others(spark, hourly):
    rows = folds(hourly, 50).unionByName(folds(hourly, 5).withColumn("series_id", F.lit("short")))
    placed = validation_fold(rows)
    assert placed.where("series_id = 'short' AND fold IS NULL").count() == rows.where("series_id = 'short'").count()
    assert placed.where("series_id <> 'short' AND fold IS NOT NULL").count() > 0
    assert expanding_folds(rows).where("series_id = 'short'").count() == 0
    bounds = fold_bounds(spark.createDataFrame([("a", 103), ("short", 4)], "series_id string, n_development bigint"))
    ends = {(r["series_id"], r["validation_end"] is None) for r in bounds.collect()}
    assert ends == {("a", False), ("short", True)}


def test_parts(hourly):
    tagged = chronological_split(hourly(range(100)))
    assert development(tagged).count() == 85 and part(tagged, "test").count() == 15
