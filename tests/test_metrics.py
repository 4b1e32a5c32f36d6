from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.functions import absolute_percentage_error
from loadcast.operators.distribution import calibration_bounds, histogram
from loadcast.operators.metrics import (
    backtest_summary,
    error_metrics,
    forecast_quality,
    relative_improvement,
    residual_diagnostics,
    window_metrics,
)
from loadcast.operators.quantiles import group_quantiles


def metrics(df):
    return tuple(error_metrics(df).first())


def test_perfect_forecast(pairs):
    assert metrics(pairs([100, 200], [100, 200])) == (0, 0, 0)


def test_known_values(pairs):
    assert metrics(pairs([100, 200], [110, 180])) == pytest.approx((15, math.sqrt(250), 10))


def test_zero_targets_leave_only_mape(pairs):
    mae, _, mape = metrics(pairs([0, 100], [10, 110]))
    assert (mae, mape) == pytest.approx((10, 10))
    assert math.isnan(metrics(pairs([0, 0], [1, 2]))[2])


def test_empty_and_unfinished_inputs_fail(pairs):
    with pytest.raises(PySparkException, match="must not be empty"):
        metrics(pairs([], []))
    with pytest.raises(PySparkException, match="finite"):
        metrics(pairs([1.0, float("nan")], [1, 1]))
    assert error_metrics(pairs([], []).withColumn("g", F.lit(1)), ["g"]).count() == 0


def test_an_empty_window_is_nan(pairs):
    assert all(math.isnan(v) for v in window_metrics(pairs([], [])).first())
    assert tuple(window_metrics(pairs([100, 200], [110, 180])).first()) == pytest.approx((15, math.sqrt(250), 10))


def quality(df, **options):
    return tuple(forecast_quality(df, hot=False, **options).first())


def test_r_squared_edges(pairs):
    assert quality(pairs([1, 2, 3], [1, 2, 4]))[0] == pytest.approx(0.5)
    assert quality(pairs([5, 5], [5, 5]))[0] == 1.0
    assert quality(pairs([5, 5], [5, 6]))[0] == 0.0
    assert math.isnan(quality(pairs([5], [5]))[0])
    assert all(math.isnan(v) for v in quality(pairs([], [])))


def test_residual_diagnostics(pairs):
    rng = np.random.default_rng(3)
    y, p = rng.normal(50, 9, 501), rng.normal(50, 9, 501)
    e = y - p
    for hot in (False, True):
        row = residual_diagnostics(pairs(y, p), hot=hot).first()
        assert row["rows"] == 501
        assert row["mean_residual"] == pytest.approx(e.mean())
        assert row["median_residual"] == pytest.approx(np.median(e))
        assert row["residual_std"] == pytest.approx(e.std(ddof=1))
        assert row["median_absolute_error"] == pytest.approx(np.median(np.abs(e)))
        assert row["p95_absolute_error"] == pytest.approx(np.quantile(np.abs(e), 0.95))
        assert row["max_absolute_error"] == pytest.approx(np.abs(e).max())
        assert row["mean_absolute_percentage_error"] == pytest.approx((np.abs(e) / np.abs(y) * 100).mean())


def test_percentage_error_of_zero_is_unknown(pairs):
    found = pairs([0, 4], [1, 5]).select(absolute_percentage_error(F.col("y"), F.col("prediction")).alias("ape"))
    assert [r["ape"] for r in found.collect()] == [None, 25.0]


def test_backtest_summary_has_both_deviations(spark):
    rows = [(f, m, v, v, v, 1.0, 2.0) for m, vs in (("a", (1.0, 3.0)), ("b", (5.0,))) for f, v in enumerate(vs)]
    schema = "fold int, model string, MAE double, RMSE double, MAPE double, train_seconds double, predict_seconds double"
    found = {r["model"]: r for r in backtest_summary(spark.createDataFrame(rows, schema)).collect()}
    assert found["a"]["MAPE_std"] == pytest.approx(math.sqrt(2)) and found["a"]["MAPE_variability"] == 1.0
    assert found["b"]["MAPE_std"] is None and found["b"]["MAPE_variability"] == 0.0


def test_improvement_over_a_zero_baseline_is_unknown(spark):
    table = spark.createDataFrame(
        [("x", "n", 8.0), ("x", "m", 4.0), ("z", "n", 0.0), ("z", "m", 4.0)], "g string, model string, MAPE double"
    )
    found = {(r["g"], r["model"]): r[3] for r in relative_improvement(table, "n", ["g"]).collect()}
    assert found == {("x", "n"): 0.0, ("x", "m"): 50.0, ("z", "n"): None, ("z", "m"): None}


def test_histogram_keeps_every_value(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 5) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values], "residual double")
    found = {r["bin"]: r["count"] for r in histogram(df).collect()}
    want, _ = np.histogram(values, bins=55)
    assert found == {i: n for i, n in enumerate(want) if n}
    same = spark.createDataFrame([(2.0,), (2.0,)], "residual double")
    assert [(r["bin"], r["count"]) for r in histogram(same).collect()] == [(0, 2)]


def test_calibration_bounds_cover_both(pairs):
    assert tuple(calibration_bounds(pairs([1, 5], [2, 9])).first()) == (1, 9)


# --- exact quantiles of groups too large for one task --------------------------


def narrowed(spark, groups, wanted, limit=20):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    found = group_quantiles(df, ["g"], F.col("x"), wanted, hot=True, rows_per_task=limit)
    return {r["g"]: [r[n] for n in wanted] for r in found.collect()}


def test_narrowing_is_exact_on_awkward_groups(spark):
    rng = np.random.default_rng(4)
    groups = {
        "uniform": rng.uniform(0, 1, 3000),
        "heavy_tail": rng.pareto(0.5, 2000),
        "one_value": [7.0] * 1500,
        "mostly_one_value": [0.0] * 1400 + list(rng.normal(0, 1, 700)),
        "two_values": [1.0] * 500 + [2.0] * 501,
        "signed": rng.normal(0, 1e6, 1000),
        "tiny": [3.0],
        "pair": [1.0, 2.0],
    }
    wanted = {"q01": 0.01, "q50": 0.5, "q99": 0.99}
    found = narrowed(spark, groups, wanted)
    for name, values in groups.items():
        np.testing.assert_allclose(found[name], np.quantile(values, list(wanted.values())), rtol=1e-12, err_msg=name)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.sampled_from([0.0, 1.0, -1.0]), st.floats(-1e3, 1e3)), min_size=1, max_size=120),
    st.floats(0.01, 0.99),
)
def test_narrowing_equals_sorting(spark, values, q):
    found = narrowed(spark, {"g": values}, {"q": q}, limit=5)["g"][0]
    assert found == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-9)


def test_narrowing_without_groups_and_with_bad_values(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert group_quantiles(df, [], F.col("x"), {"q": 0.25}, hot=True, rows_per_task=10).first()["q"] == 250.0
    with pytest.raises(PySparkException, match="finite"):
        group_quantiles(df.select(F.lit(float("inf")).alias("x")), [], F.col("x"), {"q": 0.5}, hot=True).collect()


def test_group_size_decides_the_path(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    for limit in (10, 1000):
        found = group_quantiles(df, ["g"], F.col("x"), {"q": 0.5}, rows_per_task=limit).orderBy("g").collect()
        assert [r["q"] for r in found] == [24.0, 25.0]


def test_narrowing_goes_on_past_a_group_that_is_stuck(spark):
    """One group has all its mass on two values, the other has many: both are exact and agree with the built-in."""
    rows = spark.range(6000).selectExpr("'two' AS g", "CAST(id % 2 AS DOUBLE) AS v").unionByName(
        spark.range(6000).selectExpr("'many' AS g", "CAST(hash(id) AS DOUBLE) / 7 AS v")
    )
    wanted = {"p37": 0.37, "p50": 0.5, "p99": 0.99}
    plain = group_quantiles(rows, ["g"], F.col("v"), wanted, hot=False).orderBy("g").collect()
    narrowed = group_quantiles(rows, ["g"], F.col("v"), wanted, hot=True, rows_per_task=100).orderBy("g").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in narrowed]
