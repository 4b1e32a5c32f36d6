from __future__ import annotations

import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.functions import direction, severity
from loadcast.operators.alignment import alignment, validate_predictions
from loadcast.operators.anomaly import (
    anomalies_only,
    anomaly_counts,
    anomaly_summary,
    direction_mix,
    fit_residual_threshold,
    score_anomalies,
    severity_counts,
    severity_mix,
)
from loadcast.operators.layout import Layout, measure
from loadcast.operators.ranking import most_severe, seeded_sample, top_k, worst_errors
from loadcast.plans import detect, detect_within, prepare
from loadcast.operators.split import part
from loadcast.streaming import score_stream

SCHEMA = "series_id string, ts timestamp_ntz, y double, prediction double"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


@pytest.fixture
def predictions(spark):
    def build(actual, predicted, series="all"):
        rows = [(series, at(i), float(a), float(p)) for i, (a, p) in enumerate(zip(actual, predicted))]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def test_residual_is_actual_minus_predicted(predictions):
    found = score_anomalies(predictions([100, 120, 80], [90, 125, 70]), 1.0).orderBy("ts")
    assert [r["residual"] for r in found.collect()] == [10, -5, 10]


def test_threshold_is_the_quantile_of_absolute_residuals(predictions):
    rows = predictions([-1, 2, -3, 4], [0, 0, 0, 0])
    for hot in (False, True):
        found = fit_residual_threshold(rows, quantile=0.75, hot=hot).first()
        assert (found["quantile"], found["threshold"]) == (0.75, pytest.approx(3.25))


@pytest.mark.parametrize("quantile", [0, 1, 1.5])
def test_bad_quantile(predictions, quantile):
    with pytest.raises(ValueError, match="between 0 and 1"):
        fit_residual_threshold(predictions([1], [1]), quantile=quantile)


def test_threshold_must_be_positive_and_inputs_finite(predictions):
    with pytest.raises(PySparkException, match="must be positive"):
        fit_residual_threshold(predictions([1, 2], [1, 2]), hot=False).collect()
    with pytest.raises(PySparkException, match="must not be empty"):
        fit_residual_threshold(predictions([], []), hot=False).collect()
    with pytest.raises(PySparkException, match="finite"):
        fit_residual_threshold(predictions([1, float("nan")], [1, 2]), hot=False).collect()


def test_a_flat_series_does_not_stop_the_others(spark):
    rows = spark.createDataFrame(
        [("flat", 1.0, 1.0)] * 4 + [("a", float(i), 0.0) for i in range(5)], "series_id string, y double, prediction double"
    )
    for hot in (False, True):
        found = {r["series_id"]: r for r in fit_residual_threshold(rows, ["series_id"], 0.75, hot=hot).collect()}
        assert (found["flat"]["threshold"], found["flat"]["status"]) == (None, "not positive")
        assert (found["a"]["threshold"], found["a"]["status"]) == (3.0, "ok")
    with pytest.raises(PySparkException, match="must be positive"):
        fit_residual_threshold(rows, ["series_id"], 0.75, hot=False, strict=True).collect()


@pytest.mark.parametrize("staged", [False, True])
def test_layouts_give_one_contract(spark, hourly, staged):
    """A flat series, one too short to have validation rows, and an ordinary one."""
    rows = hourly([100 + 10 * math.sin(i) + i % 7 for i in range(400)], "a")
    rows = rows.unionByName(hourly([5] * 400, "flat")).unionByName(hourly(range(194), "short"))
    short = measure(rows, "series_id")
    blocks = replace(short, always_blocks=True, block_rows=256)
    results = []
    for layout in (short, blocks):
        found = detect_within(prepare(rows, layout=layout, staged=staged), "lag_168", layout=layout, staged=staged)
        results.append(
            (
                sorted(map(tuple, found.thresholds.select("series_id", "quantile", "threshold", "status").collect())),
                sorted(map(tuple, found.scored.select("series_id", "ts", "is_anomaly", "severity").collect()), key=str),
                sorted(
                    map(tuple, found.summary.select("series_id", "threshold_quantile", "threshold_mw", "anomaly_count").collect())
                ),
            )
        )
    assert results[0] == results[1]
    assert {(t[0], t[3]) for t in results[0][0]} == {("a", "ok"), ("flat", "not positive"), ("short", "no calibration rows")}


def test_flags_large_errors_of_both_signs(predictions):
    found = score_anomalies(predictions([100, 150, 50, 105], [100] * 4), 40.0).orderBy("ts").collect()
    assert [r["is_anomaly"] for r in found] == [False, True, True, False]
    assert [r["absolute_residual"] for r in found] == [0, 50, 50, 5]
    assert not score_anomalies(predictions([140], [100]), 40.0).first()["is_anomaly"]


@pytest.mark.parametrize("threshold", [0.0, -1.0, float("nan"), float("inf")])
def test_bad_threshold(predictions, threshold):
    with pytest.raises(ValueError, match="positive"):
        score_anomalies(predictions([1], [1]), threshold)


def test_directions_and_severities(spark):
    signs = spark.createDataFrame([(100.0,), (-100.0,), (0.0,)], "r double").select(direction(F.col("r")))
    assert [r[0] for r in signs.collect()] == ["spike", "drop", "neutral"]
    cases = [(0.5, False), (1.1, True), (1.5, True), (1.99, True), (2.0, True), (3.0, True)]
    graded = spark.createDataFrame(cases, "s double, a boolean").select(severity(F.col("s"), F.col("a")))
    assert [r[0] for r in graded.collect()] == ["normal", "moderate", "high", "high", "critical", "critical"]


def test_rows_without_a_threshold_are_kept(predictions, spark):
    rows = predictions([1, 50], [0, 0]).union(predictions([9], [0], series="new"))
    limits = spark.createDataFrame([("all", 10.0)], "series_id string, threshold double")
    found = {(r["series_id"], r["y"]): r for r in score_anomalies(rows, limits, n_series=1).collect()}
    assert len(found) == 3 and found[("all", 50.0)]["severity"] == "critical"
    unknown = found[("new", 9.0)]
    assert unknown["is_anomaly"] is None and unknown["severity"] is None and unknown["direction"] == "spike"


def graded(predictions):
    return score_anomalies(predictions([10, 16, 17, 25, -12, 3, 0], [0] * 7), 10.0)


def test_counts_and_mixes(predictions):
    scored = graded(predictions)
    counts = anomaly_counts(scored).first()
    assert tuple(counts) == (7, 4, pytest.approx(4 / 7 * 100), 3, 1, 1)
    events = anomalies_only(scored)
    assert [tuple(r) for r in severity_mix(events).orderBy("level").collect()] == [
        (1, "moderate", 1),
        (2, "high", 2),
        (3, "critical", 1),
    ]
    assert {r["severity"]: r["count"] for r in severity_counts(events).collect()} == {"moderate": 1, "high": 2, "critical": 1}
    assert tuple(direction_mix(events).first()) == (3, 1, 75.0, 25.0, "SPIKES")
    nothing = events.where("y > 1000")
    assert tuple(direction_mix(nothing).first()) == (0, 0, 0.0, 0.0, "BALANCED")
    assert [r["count"] for r in severity_mix(nothing).collect()] == [0, 0, 0]
    assert [r["y"] for r in most_severe(events).collect()] == [25, 17, 16, -12]


def test_summary_record(predictions, spark):
    limits = spark.createDataFrame([("all", 0.99, 10.0)], "series_id string, quantile double, threshold double")
    row = anomaly_summary(graded(predictions), limits, ["series_id"], k=3).first()
    assert row["anomaly_count"] == 4 and row["severity_counts"] == {"moderate": 1, "high": 2, "critical": 1}
    assert [t["severity_score"] for t in row["top_anomalies"]] == [2.5, 1.7, 1.6]
    assert row["top_anomalies"][0]["datetime"] == "2024-01-01T03:00:00"
    assert (row["threshold_mw"], row["threshold_fit_on_final_test"]) == (10.0, False)
    calm = anomaly_summary(graded(predictions).where("not is_anomaly"), limits.drop("series_id"), [], k=3).first()
    assert calm["top_anomalies"] == [] and calm["severity_counts"] == {} and calm["anomaly_count"] == 0


def test_alignment(predictions):
    saved, reserved = predictions([1, 2, 3], [0] * 3), predictions([1, 2, 3], [0] * 3)
    validate_predictions(saved.orderBy(F.desc("ts")), reserved)
    with pytest.raises(ValueError, match=r"missing required columns: \['prediction'\]"):
        validate_predictions(saved.drop("prediction"), reserved)
    with pytest.raises(ValueError, match="row count"):
        validate_predictions(saved.where("y < 3"), reserved)
    moved = saved.withColumn("ts", F.when(F.col("y") == 3, F.lit("2025-01-01").cast("timestamp_ntz")).otherwise(F.col("ts")))
    with pytest.raises(ValueError, match="timestamps do not match"):
        validate_predictions(moved, reserved)
    repeated = saved.where("y < 3").union(saved.where("y = 2"))
    with pytest.raises(ValueError, match="timestamps do not match"):
        validate_predictions(repeated, reserved)
    assert alignment(repeated, reserved).first()["repeated_keys"] == 1
    ahead = saved.withColumn("rn", F.col("y") + 1)
    with pytest.raises(ValueError, match="timestamps do not match"):
        validate_predictions(ahead, reserved.withColumn("rn", F.col("y")), positions=True)


def test_all_ways_to_detect_agree(hourly, spark):
    rng = np.random.default_rng(9)
    rows = hourly(rng.normal(100, 10, 900), "a").union(hourly(rng.normal(50, 20, 700), "b"))
    short, blocks = Layout(2, 0, 0), Layout(2, 1600, 900, block_rows=256, always_blocks=True)
    frame = prepare(rows, layout=short)
    within = detect_within(frame, "lag_168", quantile=0.9, layout=short).scored
    joined = detect(
        part(frame, "validation"), part(frame, "test"), quantile=0.9, layout=short, calibrated_by="lag_168", scored_by="lag_168"
    ).scored
    cut = detect_within(prepare(rows, layout=blocks), "lag_168", quantile=0.9, layout=blocks).scored
    want = within.select(*joined.columns).orderBy("series_id", "ts").toPandas()
    for other in (joined, cut):
        got = other.select(*joined.columns).orderBy("series_id", "ts").toPandas()
        np.testing.assert_allclose(got["severity_score"], want["severity_score"], rtol=1e-9)
        assert (got[["ts", "is_anomaly", "severity", "direction"]] == want[["ts", "is_anomaly", "severity", "direction"]]).all(None)
    assert want["is_anomaly"].sum() > 0


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id >= 0 AS g", "id AS v")
    ranked = top_k(df, 3, [F.desc("v")], ["g"])
    assert sorted(r["v"] for r in ranked.collect()) == [997, 998, 999]
    shown = ranked._jdf.queryExecution().executedPlan().toString()
    assert shown.index("Exchange") < shown.rindex("WindowGroupLimit")


def test_worst_errors_keep_the_earlier_row_on_a_tie(predictions):
    rows = predictions([5, 9, 9, 1], [0] * 4).withColumn("absolute_error", F.col("y"))
    assert [r["ts"] for r in worst_errors(rows, 2).collect()] == [at(1), at(2)]
    assert [r["ts"] for r in worst_errors(rows, 1, ["series_id"]).collect()] == [at(1)]


def test_sample_is_whole_when_small_and_the_same_under_repartitioning(hourly):
    df = hourly(range(300))
    first = {r["ts"] for r in seeded_sample(df, 40).collect()}
    assert len(first) == 40 and first == {r["ts"] for r in seeded_sample(df.repartition(7), 40).collect()}
    assert first != {r["ts"] for r in seeded_sample(df, 40, seed=1).collect()}
    assert seeded_sample(df, 5000).count() == 300


def test_a_stream_is_scored_like_a_batch(spark, predictions, tmp_path):
    batch = predictions([100, 150, 50, 105], [100] * 4)
    batch.write.parquet(str(tmp_path / "in"))
    limits = spark.createDataFrame([("all", 40.0)], "series_id string, threshold double")
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = (
        score_stream(stream, limits, n_series=1)
        .writeStream.format("memory")
        .queryName("scored_stream")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    assert sorted(spark.table("scored_stream").collect()) == sorted(score_anomalies(batch, limits).collect())
    with pytest.raises(ValueError, match="streaming"):
        score_stream(batch, 1.0)
