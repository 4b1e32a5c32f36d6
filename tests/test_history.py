from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from loadcast.functions import with_calendar
from loadcast.operators.history import forecast_features, rolling_mae, seasonal_naive
from loadcast.operators.layout import Layout, measure
from loadcast.operators.ordering import cut_into_blocks, number_rows, with_halo
from loadcast.operators.split import chronological_split, complete_cases
from loadcast.plans import prepare
from loadcast.schema import FEATURE_COLUMNS, HISTORY_COLUMNS

SERIES = Layout(n_series=1, n_rows=0, max_rows=0)
BLOCKS = Layout(n_series=1, n_rows=0, max_rows=0, block_rows=256, always_blocks=True)


def table(df, *columns):
    return df.orderBy("series_id", "ts").select(*columns).toPandas()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar_counts_from_monday(spark):
    rows = [(dt.datetime(2024, 1, 1, 14),), (dt.datetime(2024, 1, 6, 9),)]
    found = with_calendar(spark.createDataFrame(rows, "ts timestamp_ntz")).orderBy("ts").collect()
    assert [tuple(r)[1:] for r in found] == [(14, 0, 1, 1, 0), (9, 5, 1, 6, 1)]
    with pytest.raises(ValueError, match="Missing required column: ts"):
        with_calendar(spark.createDataFrame([(1,)], "x int"))


def test_ramp_features(hourly):
    ramp = hourly(range(1000, 1250))
    found = table(forecast_features(ramp, layout=SERIES), *FEATURE_COLUMNS)
    assert list(found.columns) == FEATURE_COLUMNS
    assert found["lag_24"][24] == found["lag_48"][48] == found["lag_168"][168] == 1000
    assert found["rolling_mean_24"][47] == pytest.approx(np.mean(range(1000, 1024)))
    assert found["rolling_mean_24"].first_valid_index() == 47
    assert found["rolling_std_24"].first_valid_index() == 47
    assert found["rolling_mean_168"].first_valid_index() == 191


@pytest.mark.parametrize("layout", [SERIES, BLOCKS], ids=["series", "blocks"])
def test_features_equal_pandas_with_missing_values(hourly, layout):
    random.seed(5)
    values = [None if random.random() < 0.01 else random.uniform(-50, 90) for _ in range(900)]
    found = table(forecast_features(hourly(values), layout=layout), *HISTORY_COLUMNS)
    y = pd.Series(values, dtype=float)
    past = y.shift(24)
    want = {
        "lag_24": y.shift(24),
        "lag_48": y.shift(48),
        "lag_168": y.shift(168),
        "rolling_mean_24": past.rolling(24).mean(),
        "rolling_std_24": past.rolling(24).std(),
        "rolling_mean_168": past.rolling(168).mean(),
    }
    for name, series in want.items():
        np.testing.assert_allclose(found[name].astype(float), series, rtol=1e-9, atol=1e-9, err_msg=name)


def test_features_do_not_see_the_next_24_rows(hourly):
    random.seed(11)
    values = [random.uniform(0, 100) for _ in range(420)]
    before = table(forecast_features(hourly(values), layout=SERIES), *HISTORY_COLUMNS)
    for cut in random.sample(range(200, 400), 3):
        changed = values[:cut] + [999999.0] * (len(values) - cut)
        after = table(forecast_features(hourly(changed), layout=SERIES), *HISTORY_COLUMNS)
        pd.testing.assert_frame_equal(before[: cut + 24], after[: cut + 24])


def test_missing_target_is_named_in_required_order(spark):
    with pytest.raises(ValueError, match=r"Missing required columns: \['ts', 'y'\]"):
        forecast_features(spark.createDataFrame([(1,)], "x int"))


def test_seasonal_naive(hourly):
    found = table(seasonal_naive(hourly(range(200)), layout=SERIES), "prediction")["prediction"]
    assert np.isnan(found[167]) and found[168] == 0 and found[169] == 1
    with pytest.raises(ValueError, match="greater than 0"):
        seasonal_naive(hourly(range(3)), lag_rows=0)


@pytest.mark.parametrize("layout", [SERIES, BLOCKS], ids=["series", "blocks"])
@pytest.mark.parametrize("rows,least", [(168, 24), (7, 3), (12, 1)])
def test_rolling_mae_equals_pandas(hourly, layout, rows, least):
    random.seed(2)
    errors = [random.uniform(0, 9) for _ in range(700)]
    df = hourly(errors).withColumnRenamed("y", "absolute_error")
    found = table(rolling_mae(df, window_rows=rows, min_rows=least, layout=layout), "rolling_mae_7d")
    want = pd.Series(errors).rolling(rows, min_periods=least).mean()
    np.testing.assert_allclose(found["rolling_mae_7d"], want, rtol=1e-9)


@pytest.fixture(scope="module")
def uneven(spark):
    """One series with most rows, several shorter ones, one of a single row."""
    rng = random.Random(7)
    rows = []
    for name, length in (("b", 2000), ("a", 300), ("c", 511), ("d", 1), ("e", 40)):
        at = dt.datetime(2023, 5, 1)
        for _ in range(length):
            at += dt.timedelta(minutes=rng.randint(1, 200))
            rows.append((name, at, rng.uniform(0, 100)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double").repartition(5)


@pytest.mark.parametrize("block_rows", [192, 256, 1000])
def test_blocks_give_the_same_frame_as_whole_series(uneven, block_rows):
    blocks = Layout(5, 2852, 2000, block_rows=block_rows, always_blocks=True)
    whole, cut = prepare(uneven, layout=SERIES), prepare(uneven, layout=blocks)
    left, right = table(whole, *whole.columns), table(cut, *whole.columns)
    pd.testing.assert_frame_equal(left, right, rtol=1e-9)
    assert len(left) == 2000 - 191 + 300 - 191 + 511 - 191


def test_blocks_hold_equal_numbers_of_rows(uneven):
    sizes = cut_into_blocks(uneven, 256).groupBy("_block").count().orderBy("_block").toPandas()["count"]
    assert (sizes[:-1] == 256).all() and sizes.sum() == 2852
    with pytest.raises(ValueError, match="look-back"):
        with_halo(cut_into_blocks(uneven, 100), 191, 100)


def test_positions_are_dense_and_do_not_depend_on_partitioning(uneven):
    first = table(number_rows(uneven, layout=SERIES), "series_id", "ts", "rn", "n_rows")
    for other in (uneven.repartition(3), uneven.coalesce(1)):
        for layout in (SERIES, BLOCKS):
            pd.testing.assert_frame_equal(first, table(number_rows(other, layout=layout), *first.columns))
    grouped = first.groupby("series_id")
    assert (first["rn"] == grouped.cumcount()).all()
    assert (first["n_rows"] == grouped["ts"].transform("size")).all()


def test_the_layout_follows_the_longest_series(uneven):
    assert measure(uneven, "series_id", rows_per_task=1999).blocked
    layout = measure(uneven, "series_id", rows_per_task=2000)
    assert not layout.blocked and (layout.n_series, layout.n_rows, layout.max_rows) == (5, 2852, 2000)


def test_block_plan_never_windows_a_whole_series(uneven):
    shown = plan(forecast_features(uneven, layout=BLOCKS))
    windows = [line for line in shown.splitlines() if "Window [" in line]
    assert windows and all("_block" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)
    assert "SinglePartition" not in shown


def test_partitions_grow_with_the_measured_rows(uneven):
    many = Layout(5, 2852, 1, rows_per_task=100)
    assert many.tasks == 29 and Layout(5, 2852, 2000).tasks == 1 and Layout(1, 10**15, 1).tasks == 100_000
    short = Layout(5, 2852, 90, rows_per_task=100, block_rows=256)
    assert plan(forecast_features(uneven, layout=short)).count("29), REPARTITION_BY_NUM") == 1
    blocks = Layout(5, 2852, 2000, rows_per_task=100, block_rows=256)
    cut = forecast_features(uneven, layout=blocks)
    assert plan(cut).count("29), REPARTITION_BY_NUM") == 1
    whole = forecast_features(uneven, layout=SERIES)
    pd.testing.assert_frame_equal(table(whole, *whole.columns), table(cut, *whole.columns), rtol=1e-9)


def test_series_plan_shuffles_once(uneven):
    shown = plan(prepare(uneven, layout=SERIES))
    assert shown.count("Exchange hashpartitioning") == 1 and shown.count("Sort [") == 1


def test_rows_with_unknown_time_come_last_and_are_dropped(spark, hourly):
    rows = hourly(range(240)).union(spark.sql("SELECT 'all', CAST(NULL AS TIMESTAMP_NTZ), 5.0D"))
    found = table(complete_cases(forecast_features(rows, layout=SERIES)), "ts", "lag_168")
    assert len(found) == 240 - 191 and found["lag_168"][0] == 191 - 168


def test_time_zone_of_the_session_does_not_matter(spark, hourly):
    df = hourly(range(2000))
    utc = table(chronological_split(forecast_features(df, layout=SERIES), layout=SERIES), *FEATURE_COLUMNS, "split")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = table(chronological_split(forecast_features(df, layout=SERIES), layout=SERIES), *utc.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    pd.testing.assert_frame_equal(utc, local)
