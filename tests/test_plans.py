from __future__ import annotations

import datetime as dt
import importlib
import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.functions import default_window, iso_timestamp, label
from loadcast.operators.daily import Daily, daily_errors, merged_fit, merged_metrics, residual_range
from loadcast.operators.filters import in_days, members, report, with_errors
from loadcast.operators.layout import Layout
from loadcast.operators.boosting import boost, cut_back, next_rounds, stopping_round
from loadcast.operators.forests import dealt, plan_forest, plan_rounds
from loadcast.operators.metrics import forecast_quality, window_metrics
from loadcast.operators.models import (
    HOLDOUT,
    VECTOR,
    assembled,
    boosted,
    calendar_forest,
    feature_importance,
    fit_model,
    gradient_boosting,
    holdout_flag,
    importance_view,
    predict,
    random_forest,
)
from loadcast.operators.split import part
from loadcast.plans import (
    analyze,
    backtest,
    calibrate_and_detect,
    compare_models,
    final_evaluation,
    integrity_status,
    monitoring_view,
    prepare,
    select_model,
    train_baseline,
)
from loadcast.schema import CALENDAR_COLUMNS, FEATURE_COLUMNS
from loadcast.sources import claim_once, load_model, save_model, write_by_day

SMALL = {"numTrees": 4, "maxDepth": 4, "maxBins": 32}
BOOST = {"maxIter": 3, "maxDepth": 3, "maxBins": 32}
SHORT = Layout(1, 0, 0)


@pytest.fixture(scope="module")
def frame(hourly):
    """Daily and weekly cycle with noise: 600 usable rows."""
    hours = np.arange(791)
    rng = np.random.default_rng(1)
    load = 1000 + 200 * np.sin(hours / 24 * 2 * np.pi) + 80 * np.sin(hours / 168 * 2 * np.pi) + rng.normal(0, 40, 791)
    return prepare(hourly(load), layout=SHORT, staged=True)


@pytest.fixture(scope="module")
def trained(frame):
    return train_baseline(frame, estimator=random_forest(**SMALL))


def test_a_part_of_the_staged_frame_reads_its_own_folder(frame):
    shown = part(frame, "test").select("y")._jdf.queryExecution().executedPlan().toString()
    assert "split" in shown.split("PartitionFilters: [")[1].split("]")[0] and part(frame, "test").count() == 90


def test_frozen_configurations():
    forest = random_forest().getStages()[1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (100, 18, 2)
    assert (forest.getSeed(), forest.getFeatureSubsetStrategy()) == (42, "all")
    assert random_forest().getStages()[0].getInputCols() == FEATURE_COLUMNS
    boosting = gradient_boosting().getStages()[1]
    assert (boosting.getStepSize(), boosting.getMaxIter(), boosting.getMinInstancesPerNode()) == (0.08, 300, 20)
    calendar = calendar_forest().getStages()
    assert calendar[0].getInputCols() == CALENDAR_COLUMNS and calendar[1].getMaxDepth() == 30


def test_calendar_model(spark):
    rows = [(h, 0, 1, 1, 0, 1000.0 + 100 * h) for h in range(5)]
    df = spark.createDataFrame(rows, "hour int, day_of_week int, month int, day_of_year int, is_weekend int, y double")
    model = fit_model(calendar_forest(**{**SMALL, "maxDepth": 3}), df)
    found = predict(model, df).collect()
    assert len(found) == 5 and all(r["prediction"] > 0 for r in found)
    with pytest.raises(ValueError, match=r"Missing feature columns: \['hour'\]"):
        fit_model(calendar_forest(**SMALL), df.drop("hour"))
    with pytest.raises(ValueError, match="Missing target column: y"):
        fit_model(calendar_forest(**SMALL), df.drop("y"))


def test_training_run(frame, trained):
    metrics, metadata = trained.metrics.first(), trained.metadata.first()
    assert (metadata["train_rows"], metadata["validation_rows"], metadata["test_rows"]) == (420, 90, 90)
    assert metadata["test_set_evaluated"] is False and metadata["feature_columns"] == FEATURE_COLUMNS
    base, own = metrics["seasonal_naive"]["MAPE"], metrics["random_forest"]["MAPE"]
    assert metrics["mape_improvement_percent"] == pytest.approx((base - own) / base * 100)


def test_saved_model_predicts_the_same(spark, frame, trained, tmp_path):
    path = save_model(trained.model, str(tmp_path / "deep" / "model"))
    rows = part(frame, "test")
    before = predict(trained.model, rows).orderBy("ts").select("prediction").collect()
    assert before == predict(load_model(spark, path), rows).orderBy("ts").select("prediction").collect()
    with pytest.raises(FileNotFoundError, match="not found"):
        load_model(spark, str(tmp_path / "none"))


def test_importance_sums_to_one_and_falls(spark, trained):
    rows = feature_importance(trained.model).collect()
    values = [r["importance"] for r in rows]
    assert sum(values) == pytest.approx(1) and values == sorted(values, reverse=True)
    assert {r["feature"] for r in rows} == set(FEATURE_COLUMNS)
    gap = feature_importance(trained.model).union(spark.sql("SELECT 'x', CAST(NULL AS DOUBLE)"))
    shown = [r["importance"] for r in importance_view(gap).collect()]
    assert len(shown) == 11 and shown == sorted(values)


def test_patience_looks_over_a_bump():
    falling = [10.0 - i for i in range(5)]
    bump = [*falling, *[7.0] * 4, 5.0, 4.0, *[4.5] * 6, 3.9]
    # The bump of four rounds is over before five without gain; the plateau after 4.0 is not.
    found = stopping_round(bump, patience=5)
    assert (found.stopped, found.best) == (16, 11)
    assert stopping_round(bump, patience=4).stopped == 9 and stopping_round(bump, patience=4).best == 5
    assert stopping_round(bump, patience=7).stopped is None and stopping_round(bump, patience=7).best == 18
    # No gain at all, gains below the tolerance, ties, too few rounds.
    assert stopping_round([1.0] * 30, patience=20).stopped == 21 and stopping_round([1.0] * 30, patience=20).best == 1
    assert stopping_round([1.0 - i * 1e-9 for i in range(40)], patience=20).stopped == 21
    assert stopping_round([3.0, 2.0, 2.0, 2.0], patience=2).best == 2
    assert stopping_round([2.0, 1.0], patience=20).stopped is None
    with pytest.raises(ValueError, match="patience"):
        stopping_round([1.0], patience=0)


def test_boosting_goes_on_past_a_bad_round_and_is_cut_back(spark, frame):
    pipeline = gradient_boosting(**{**BOOST, "maxIter": 40, "stepSize": 0.4})
    vectors = assembled(pipeline, part(frame, "train")).persist()
    regressor = pipeline.getStages()[1]
    train, held = vectors.where(f"not {HOLDOUT}").drop(HOLDOUT), vectors.where(HOLDOUT).drop(HOLDOUT)
    found = boost(regressor, train, held, patience=4, first_rounds=5)
    curve = found.table(spark).orderBy("round").collect()
    losses = [r["loss"] for r in curve]
    assert found.rounds == stopping_round(found.losses, 4) and len(found.model.trees) == found.rounds.best
    assert losses.index(min(losses)) + 1 == found.rounds.best == sum(r["kept"] for r in curve)
    # Doubling gives the curve of one long fit, and the cut model scores like the first trees of it.
    whole = regressor.copy({regressor.maxIter: len(found.losses)}).fit(train)
    assert np.allclose(whole.evaluateEachIteration(held, "squared"), found.losses)
    short = regressor.copy({regressor.maxIter: found.rounds.best}).fit(train)
    a, b = ([r[0] for r in m.transform(held).select("prediction").collect()] for m in (short, found.model))
    assert np.allclose(a, b) and cut_back(short, 99) is short
    vectors.unpersist()


def test_boosting_without_holdout_rows_keeps_all_rounds(frame):
    pipeline = gradient_boosting(**BOOST)
    vectors = assembled(pipeline, part(frame, "train")).withColumn(HOLDOUT, F.lit(False))
    assert len(boosted(pipeline.getStages()[1], vectors).model.trees) == 3


def test_cut_back_models_are_saved_like_others(spark, frame, tmp_path):
    model = fit_model(gradient_boosting(**{**BOOST, "maxIter": 30, "stepSize": 0.9}), part(frame, "train"), patience=2)
    path = save_model(model, str(tmp_path / "boosted"))
    rows = part(frame, "test")
    before = predict(model, rows).orderBy("ts").select("prediction").collect()
    assert before == predict(load_model(spark, path), rows).orderBy("ts").select("prediction").collect()


def test_forests_share_idle_cores():
    assert plan_forest(1000, 8, 100).trees == [13] * 4 + [12] * 4
    assert plan_forest(1000, 8, 3).trees == [1, 1, 1] and plan_forest(0, 8, 2).partitions == 1
    busy = plan_forest(100_000_000, 8, 100)
    assert (busy.partitions, busy.trees) == (200, [100])
    assert plan_forest(1_500_000, 8, 10).partitions == 3 and plan_forest(1_500_000, 8, 10).trees == [5, 5]


def test_many_rows_are_dealt_out_evenly(spark, tmp_path):
    """Two files are read as few parts: the partitions of a fit follow the rows."""
    assert plan_rounds(1000, 8) == 1 and plan_rounds(0, 8) == 1 and plan_rounds(250_000, 8) == 4
    assert plan_rounds(1_500_000, 8) == 8 and plan_rounds(86_000_000, 12) == 180
    path = str(tmp_path / "rows")
    spark.range(0, 8000, 1, 2).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = [r["count"] for r in dealt(rows, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and sum(sizes) == 8000 and max(sizes) <= 520
    assert dealt(rows, 1).rdd.getNumPartitions() == 1


def test_rounds_are_not_fitted_over_and_over():
    def fits(most, first, bests):
        sizes = [first]
        while sizes[-1] < most:
            sizes.append(next_rounds(sizes[-1], most, bests(sizes[-1])))
        return sizes

    assert fits(300, 30, lambda n: n) == [30, 300]
    assert fits(300, 30, lambda n: n - 1) == [30, 90, 300]
    assert sum(fits(1000, 30, lambda n: n - 1)) < 1.6 * 1000


def test_several_forests_are_one_scorer(spark, frame):
    rows = part(frame, "train")
    model = fit_model(random_forest(**{**SMALL, "numTrees": 7}), rows)
    forests = [s for s in model.stages if hasattr(s, "getNumTrees")]
    assert len(forests) > 1 and sum(f.getNumTrees for f in forests) == 7
    scored = predict(model, rows)
    assert set(scored.columns) == {*rows.columns, "prediction"}
    vectors = model.stages[0].transform(rows).limit(20).collect()
    want = [sum(t.predict(r[VECTOR]) for f in forests for t in f.trees) / 7 for r in vectors]
    got = {(r["series_id"], r["ts"]): r["prediction"] for r in scored.collect()}
    assert [got[r["series_id"], r["ts"]] for r in vectors] == pytest.approx(want)
    shares = sum(t.featureImportances.toArray() / t.featureImportances.toArray().sum() for f in forests for t in f.trees) / 7
    found = {r["feature"]: r["importance"] for r in feature_importance(model).collect()}
    assert [found[c] for c in FEATURE_COLUMNS] == pytest.approx(list(shares))


def test_test_rows_are_scored_once(spark, frame, tmp_path):
    """Two evaluations with one claim: the second is refused before it reads a test row."""
    claim = str(tmp_path / "out" / "claims" / "final_test")
    with pytest.raises(ValueError, match="expected Random Forest"):
        final_evaluation(frame, selection(spark, "HistGradientBoosting"), estimator=random_forest(**SMALL), claim=claim)
    final_evaluation(frame, selection(spark), estimator=random_forest(**SMALL), claim=claim)
    with pytest.raises(ValueError, match="Reserved test rows already used"):
        final_evaluation(frame, selection(spark), estimator=random_forest(**SMALL), claim=claim)
    assert len([p for p in (tmp_path / "out" / "claims" / "final_test").iterdir() if not p.name.startswith(".")]) == 1


def test_of_many_claims_at_once_at_most_one_holds(spark, tmp_path):
    def attempt(_):
        try:
            return claim_once(spark, str(tmp_path / "claim"), "Rows")
        except ValueError:
            return None

    with ThreadPool(6) as pool:
        held = [h for h in pool.map(attempt, range(6)) if h]
    left = [p.name for p in (tmp_path / "claim").iterdir() if not p.name.startswith(".")]
    assert len(held) <= 1 and len(left) == len(held)


def test_holdout_is_a_fixed_tenth(hourly):
    df = hourly(range(5000)).withColumn("h", holdout_flag())
    held = {r["ts"] for r in df.where("h").collect()}
    assert 400 < len(held) < 600
    assert held == {r["ts"] for r in df.repartition(3).withColumn("h", holdout_flag()).where("h").collect()}


def test_comparison_saves_only_a_winning_challenger(spark, frame, trained, tmp_path):
    path = str(tmp_path / "challenger")
    found = compare_models(frame, trained.model, challenger=gradient_boosting(**BOOST), challenger_path=path)
    table = {r["model"]: r for r in found.table.collect()}
    assert len(table) == 3 and table["Random Forest"]["train_seconds"] is None
    assert min(table.values(), key=lambda r: r["MAPE"])["model"] == found.winner
    record = found.record.first()
    assert record["validation_winner"] == found.winner and record["test_set_evaluated"] is False
    assert set(record["models"]) == set(table)
    if found.winner == "HistGradientBoosting":
        load_model(spark, path)
    else:
        with pytest.raises(FileNotFoundError):
            load_model(spark, path)


def test_backtest_fits_only_the_past(frame):
    found = backtest(frame, estimators={"Random Forest": lambda: random_forest(**{**SMALL, "numTrees": 2})}, n_folds=2)
    rows = found.results.collect()
    assert sorted((r["fold"], r["model"]) for r in rows) == [
        (1, "Random Forest"),
        (1, "Seasonal Naive"),
        (2, "Random Forest"),
        (2, "Seasonal Naive"),
    ]
    record = found.record.first()
    assert (record["development_rows"], record["reserved_test_rows"], record["n_folds"]) == (510, 90, 2)
    assert record["winner_by_mean_mape"] == min(record["mean_mape_by_model"], key=record["mean_mape_by_model"].get)
    naive = part(frame, "train", "validation").toPandas().sort_values("rn")[255:382]
    want = ((naive["y"] - naive["lag_168"]) / naive["y"]).abs().mean() * 100
    assert next(r for r in rows if r["fold"] == 1 and r["model"] == "Seasonal Naive")["MAPE"] == pytest.approx(want)


def test_backtest_assembles_once_for_all_fits(frame, monkeypatch):
    """One vector table for two estimators and three folds; a fit reads the folders of its past."""
    module = importlib.import_module("loadcast.plans.backtest")

    assembled_for, read = [], []
    monkeypatch.setattr(module, "assembled", lambda p, *a, **k: assembled_for.append(p) or assembled(p, *a, **k))
    fit = module.fit_vectors
    monkeypatch.setattr(module, "fit_vectors", lambda r, v: read.append(v) or fit(r, v))
    makers = {
        "Random Forest": lambda: random_forest(**{**SMALL, "numTrees": 2}),
        "HistGradientBoosting": lambda: gradient_boosting(**BOOST),
    }
    rows = backtest(frame, estimators=makers, n_folds=3).results.collect()
    assert len(rows) == 9 and len(assembled_for) == 1 and len(read) == 6
    for vectors in read:
        plan = vectors._jdf.queryExecution().executedPlan().toString()
        assert "fold" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted({v.count() for v in read}) == [255, 340, 425]


MODELS = ["Random Forest", "HistGradientBoosting"]


def decision(spark, comparison, tested, **options):
    left = spark.createDataFrame(comparison, "model string, MAPE double")
    right = spark.createDataFrame(tested, "model string, MAPE_mean double, MAPE_std double")
    return select_model(left, right, **options).first()


def test_near_ties_go_to_the_better_validation(spark):
    row = decision(
        spark,
        [("Random Forest", 4.8), ("HistGradientBoosting", 5.1), ("Seasonal Naive", 1.0)],
        [("Random Forest", 4.64, 0.3), ("HistGradientBoosting", 4.60, 0.2), ("Seasonal Naive", 1.0, 0.1)],
    )
    assert (row["selected_model"], row["runner_up"]) == ("Random Forest", "HistGradientBoosting")
    assert row["selected_model_metrics"]["backtest_mean_mape"] == 4.64 and row["test_set_evaluated"] is False


def test_the_tolerance_is_inclusive(spark):
    tested = [(MODELS[0], 5.0, 0.3), (MODELS[1], 4.5, 0.2)]
    compared = [(MODELS[0], 1.0), (MODELS[1], 2.0)]
    assert decision(spark, compared, tested, tolerance=0.5)["selected_model"] == MODELS[0]
    assert decision(spark, compared, tested, tolerance=0.49)["selected_model"] == MODELS[1]


def test_a_clear_backtest_lead_decides(spark):
    row = decision(
        spark,
        [("Random Forest", 4.8), ("HistGradientBoosting", 5.1)],
        [("Random Forest", 4.7, 0.3), ("HistGradientBoosting", 4.6, 0.2)],
    )
    assert row["selected_model"] == "HistGradientBoosting"


def test_full_ties_go_to_the_steadier_model_then_the_order(spark):
    row = decision(spark, [(m, 5.0) for m in MODELS], [(MODELS[0], 4.6, 0.3), (MODELS[1], 4.6, 0.2)])
    assert row["selected_model"] == MODELS[1]
    row = decision(spark, [(m, 5.0) for m in MODELS], [(m, 4.6, 0.2) for m in MODELS])
    assert row["selected_model"] == MODELS[0]


def test_runner_up_is_the_first_other_candidate(spark):
    names = ["a", "b", "c"]
    row = decision(
        spark,
        [("a", 9.0), ("b", 2.0), ("c", 1.0)],
        [("a", 4.60, 0.2), ("b", 4.61, 0.2), ("c", 4.62, 0.2)],
        candidates=names,
    )
    assert (row["selected_model"], row["runner_up"]) == ("c", "a")


def test_selection_needs_two_candidates_and_untouched_records(spark):
    with pytest.raises(PySparkException, match="Not enough candidate models"):
        decision(spark, [(MODELS[0], 5.0)], [(MODELS[0], 4.6, 0.2), (MODELS[1], 4.6, 0.2)])
    used = spark.sql("SELECT true AS test_set_evaluated")
    for name, options in (("Comparison", {"comparison_record": used}), ("Backtest", {"backtest_record": used})):
        with pytest.raises(ValueError, match=f"{name} artifact does not confirm"):
            decision(spark, [(m, 5.0) for m in MODELS], [(m, 4.6, 0.2) for m in MODELS], **options)


def selection(spark, model="Random Forest", used="false"):
    return spark.sql(f"SELECT '{model}' AS selected_model, {used} AS test_set_evaluated")


def test_final_evaluation_guards(spark, frame):
    with pytest.raises(ValueError, match="expected Random Forest"):
        final_evaluation(frame, selection(spark, "HistGradientBoosting"))
    with pytest.raises(ValueError, match="untouched test set"):
        final_evaluation(frame, selection(spark, used="true"))
    with pytest.raises(ValueError, match="untouched test set"):
        final_evaluation(frame, selection(spark).drop("test_set_evaluated"))


def test_final_evaluation_then_detection(spark, frame):
    final = final_evaluation(frame, selection(spark), estimator=random_forest(**SMALL))
    record = final.record.first()
    assert (record["development_rows"], record["test_rows"], record["test_set_evaluated"]) == (510, 90, True)
    assert final.predictions.columns == ["series_id", "ts", "y", "prediction", "residual", "absolute_error"]
    with pytest.raises(ValueError, match="untouched"):
        final_evaluation(frame, selection(spark).select("selected_model").crossJoin(final.record.select("test_set_evaluated")))
    found = calibrate_and_detect(frame, final.predictions, estimator=random_forest(**SMALL), quantile=0.9, layout=SHORT)
    summary = found.summary.first()
    assert summary["total_scored_rows"] == 90
    assert summary["anomaly_count"] == found.anomalies.count() == summary["spike_count"] + summary["drop_count"]
    assert integrity_status(found.summary).first()["status"] == "FROZEN · LEAKAGE SAFE"
    with pytest.raises(ValueError, match="row count"):
        calibrate_and_detect(frame, final.predictions.limit(5), estimator=random_forest(**SMALL), layout=SHORT)


def test_diagnostics(frame, trained):
    found = analyze(frame, trained.model)
    record = found.record.first()
    assert record["validation_rows"] == 90 and record["test_set_evaluated"] is False
    worst = [r["absolute_error"] for r in found.worst.collect()]
    assert len(worst) == 10 and worst[0] == pytest.approx(record["max_absolute_error"])


def test_monitoring_view(frame, spark):
    rows = part(frame, "test").withColumn("prediction", F.col("lag_168"))
    events = spark.createDataFrame([], "series_id string, ts timestamp_ntz, y double, prediction double, residual double, severity_score double, direction string, severity string")
    view = monitoring_view(rows, events, layout=SHORT)
    assert view["predictions"].count() == 90
    assert [r["count"] for r in view["severity_mix"].collect()] == [0, 0, 0]
    assert tuple(view["counts"].first()) == (0, 0, 0)
    assert view["top_events"].columns[0] == "Timestamp" and view["top_events"].count() == 0
    assert sum(r["count"] for r in view["histogram"].collect()) == 90
    assert view["calibration_bounds"].first()["min_value"] > 0
    early = view["rolling_mae"].orderBy("ts").select("rolling_mae_7d").collect()
    assert early[22][0] is None and early[23][0] is not None
    outside = monitoring_view(rows, events, dt.date(1999, 1, 1), dt.date(1999, 1, 2), layout=SHORT)
    assert all(math.isnan(v) for v in outside["metrics"].first())
    assert all(math.isnan(v) for v in outside["quality"].first())


def test_days_merge_to_any_window(spark, hourly):
    """Day rows give the numbers that the rows themselves give, near a large mean, too."""
    rng = np.random.default_rng(9)
    y = 1e8 + rng.normal(0, 3, 24 * 9)
    rows = hourly(y).withColumn("prediction", F.col("y") + F.lit(0.5) * F.rand(3))
    rows = rows.withColumn("y", F.when(F.hour("ts") == 5, F.lit(0.0)).otherwise(F.col("y"))).persist()
    days = Daily(daily_errors(with_errors(rows)), rows.limit(0).selectExpr("to_date(ts) AS _day", "1 AS severity", "1 AS direction", "1L AS count"))
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 6)
    part_days, part_rows = days.window(start, end), in_days(rows, start, end)
    want = [*window_metrics(part_rows).first(), *forecast_quality(part_rows).first()[:2]]
    assert [*merged_metrics(part_days.errors).first(), *merged_fit(part_days.errors).first()] == pytest.approx(want)
    steady = daily_errors(with_errors(rows.withColumn("y", F.lit(1e8)).withColumn("prediction", F.lit(1e8))))
    assert tuple(merged_fit(steady).first()) == (1.0, 0.0)
    none = days.window(dt.date(1999, 1, 1), dt.date(1999, 1, 2))
    assert all(math.isnan(v) for v in [*merged_metrics(none.errors).first(), *merged_fit(none.errors).first()])
    low, high = residual_range(part_days.errors)
    assert tuple(spark.range(1).select(low, high).first()) == tuple(with_errors(part_rows).selectExpr("min(residual)", "max(residual)").first())


def test_a_window_of_a_table_stored_by_day_reads_its_folders(spark, hourly, tmp_path):
    path = write_by_day(hourly(range(24 * 20)), str(tmp_path / "days"), ranges=3)
    stored = spark.read.parquet(path)
    shown = in_days(stored, dt.date(2024, 1, 4), dt.date(2024, 1, 6))
    plan = shown.select("y")._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_day" in pruned and "2024-01-04" in pruned and "2024-01-06" in pruned
    assert [r["y"] for r in shown.orderBy("ts").collect()] == list(range(72, 144))
    rows = shown.withColumn("file", F.input_file_name())
    # A file has rows of one day, in order.
    assert rows.select("file", "_day").distinct().count() == rows.select("file").distinct().count()
    assert len(list((tmp_path / "days").glob("_day=*"))) == 20


def test_view_reads_predictions_twice(spark, frame, tmp_path):
    """Once for the day rows and once for the window; every table then reads what was staged."""
    rows = part(frame, "test").withColumn("prediction", F.col("lag_168"))
    path = write_by_day(rows.select("series_id", "ts", "y", "prediction"), str(tmp_path / "p"))
    events = spark.createDataFrame([], "series_id string, ts timestamp_ntz, y double, prediction double, residual double, severity_score double, direction string, severity string")
    view = monitoring_view(spark.read.parquet(path), events, layout=SHORT)
    for name, table in view.items():
        assert str(tmp_path) not in table._jdf.queryExecution().executedPlan().toString(), name


def test_filters(spark, hourly):
    df = hourly(range(72))
    day = in_days(df, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    assert [r["y"] for r in day.orderBy("ts").collect()] == list(range(24, 48))
    assert default_window(dt.date(2024, 1, 1), dt.date(2024, 3, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    assert default_window(dt.date(2024, 2, 20), dt.date(2024, 3, 1))[0] == dt.date(2024, 2, 20)
    assert members(df, "series_id", []).count() == 0 and members(df, "series_id", ["all"]).count() == 72
    halves = spark.createDataFrame([(0.25,), (0.35,), (-0.25,)], "x double")
    assert [r["X"] for r in report(halves, {"x": "X"}, {"x": 1}).collect()] == [0.2, 0.4, -0.2]
    saved = spark.createDataFrame([(5.0, 4.0, -9.0)], "y double, prediction double, residual double")
    assert with_errors(saved).first()["absolute_error"] == 9.0
    assert with_errors(saved.drop("residual")).first()["residual"] == 1.0


def test_window_predicate_reaches_the_scan(spark, hourly, tmp_path):
    hourly(range(72)).write.parquet(str(tmp_path / "t"))
    df = in_days(spark.read.parquet(str(tmp_path / "t")), dt.date(2024, 1, 2), dt.date(2024, 1, 2)).select("y")
    shown = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in shown and "series_id" not in shown.split("ReadSchema")[1]


def test_text(spark):
    row = spark.sql("SELECT 'unseen_validation' AS a, TIMESTAMP_NTZ '2018-07-20 19:00:00' AS t").select(
        label(F.col("a")), iso_timestamp(F.col("t"))
    ).first()
    assert tuple(row) == ("UNSEEN VALIDATION", "2018-07-20T19:00:00")


@pytest.mark.parametrize(
    "flags,want",
    [
        ("1 AS x", "FROZEN · LEAKAGE SAFE"),
        ("true AS threshold_fit_on_final_test", "REVIEW REQUIRED"),
        ("true AS validation_seen_by_calibration_model", "REVIEW REQUIRED"),
        ("CAST(NULL AS BOOLEAN) AS threshold_fit_on_final_test", "FROZEN · LEAKAGE SAFE"),
    ],
)
def test_integrity(spark, flags, want):
    assert integrity_status(spark.sql(f"SELECT {flags}")).first()["status"] == want
