"""Every registered query: the library run over the test tables."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast import functions as fn
from loadcast.operators import alignment as al
from loadcast.operators import anomaly as an
from loadcast.operators import boosting as bo
from loadcast.operators import distribution as ds
from loadcast.operators import filters as fl
from loadcast.operators import history as hi
from loadcast.operators import metrics as me
from loadcast.operators import models as mo
from loadcast.operators import ordering as od
from loadcast.operators import quantiles as qu
from loadcast.operators import ranking as rk
from loadcast.operators import split as sp
from loadcast.operators.layout import Layout, measure
from loadcast.plans import (
    Detection,
    analyze,
    backtest,
    backtest_record,
    calibrate_and_detect,
    compare_models,
    comparison_record,
    comparison_table,
    daily_tables,
    detect,
    detect_within,
    final_evaluation,
    fold_metrics,
    integrity_status,
    monitoring_view,
    prepare,
    select_model,
    stored_view,
    train_baseline,
)
from loadcast.plans.backtest import fold_row_counts
from loadcast.plans.training import run_metadata
from loadcast.schema import CANDIDATE_MODELS, FEATURE_COLUMNS, SeriesColumns
from loadcast.session import stage, staging_dir
from loadcast.sources import (
    load_model,
    load_predictions,
    load_record,
    load_series,
    save_model,
    save_record,
    write_by_day,
    write_table,
)

from .fixtures import (
    daily_orders,
    hourly,
    hourly_by_type,
    long_form,
    long_series,
    naive,
    panel,
    panel_frame,
    panel_layout,
    rounded,
    table,
)

STAND_INS = ["lag_24", "rolling_mean_24"]
SCORED = ["series_id", "ts", "y", "prediction", "residual", "absolute_residual", "is_anomaly", "severity_score", "direction", "severity"]
# Fewer and shallower trees than the frozen forest for queries that fit several; ``frozen_forest`` fits that.
SMALL_FOREST = {"numTrees": 10, "maxDepth": 6}


def long_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """Measured, but always blocks, and short ones, so that a small table has several."""
    measured = measure(long_series(spark, sf_dir), "series_id")
    return replace(measured, always_blocks=True, block_rows=2048)


def scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(staging_dir(spark), "checks", f"{name}-{uuid.uuid4().hex}")


# --- sources ---------------------------------------------------------------


def load_series_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = SeriesColumns("o_orderstatus", "o_orderdate", "o_totalprice")
    return load_series(spark, f"{sf_dir}/orders.parquet", cols, format="parquet").select(
        "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderkey", "o_custkey", "o_orderpriority"
    )


def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file with repeated times, in no order, and rows without a target."""
    cols = SeriesColumns("o_orderstatus", "o_orderdate", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.col("o_orderdate").cast("string").alias("o_orderdate"), price.alias("o_totalprice")
    )
    path = scratch(spark, "csv")
    rows.unionByName(rows).repartition(3).write.option("header", True).csv(path)
    return load_series(spark, path, cols).select("o_orderstatus", "o_orderdate", "o_totalprice")


def load_mixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of CSV files with three column orders, some without the further column."""
    cols = SeriesColumns("o_orderstatus", "o_orderdate", "o_totalprice")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_totalprice", "o_custkey", "o_orderkey"
    )
    path = scratch(spark, "mixed")
    orders = (
        ["o_orderstatus", "o_orderdate", "o_totalprice", "o_custkey"],
        ["o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"],
        ["o_totalprice", "o_orderstatus", "o_orderdate"],
    )
    for i, names in enumerate(orders):
        part = rows.where(F.col("o_orderkey") % 3 == i).select(*names)
        part.write.mode("append").option("header", True).csv(path)
    found = load_series(spark, path, cols, unique=True)
    return found.select("o_orderstatus", "o_orderdate", "o_totalprice", F.col("o_custkey").cast("long"))


def load_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_type").alias("series_id"), fn.floor_hour(F.col("ts")).alias("ts"), F.col("value").alias("y")
    )
    return od.drop_duplicate_times(rows)


def predictions_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    saved = naive(sp.part(frame, "test")).select("series_id", "ts", "y", "prediction")
    path = write_table(saved, scratch(spark, "predictions"), "csv")
    return load_predictions(spark, path).select("series_id", "ts", "y", "prediction", "residual", "absolute_error")


def record_indented_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record written with indentation, as other tools write it, and read back."""
    frame, _ = panel_frame(spark, sf_dir)
    record = run_metadata(frame, "y")
    path = scratch(spark, "indented")
    record.select(F.to_json(F.struct("*"), {"pretty": "true"})).write.text(path)
    return load_record(spark, path, record.schema).select("model_type", "target_column", "train_rows", "test_rows")


def run_record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    record = run_metadata(frame, "y")
    path = save_record(record, scratch(spark, "metadata"))
    return load_record(spark, path, record.schema).select(
        "model_type",
        "target_column",
        F.array_join("feature_columns", ",").alias("feature_columns"),
        "train_rows",
        "validation_rows",
        "test_rows",
        "test_set_evaluated",
        "random_state",
    )


# --- features and split ------------------------------------------------------


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.with_calendar(hourly_by_type(spark, sf_dir))


def feature_output(df: DataFrame, *more: str) -> DataFrame:
    return rounded(df.select("series_id", "ts", "y", *more, *FEATURE_COLUMNS))


def forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_output(hi.forecast_features(hourly(spark, sf_dir)))


def panel_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_output(hi.forecast_features(panel(spark, sf_dir), layout=panel_layout(spark, sf_dir)))


def halo_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_output(hi.forecast_features(long_series(spark, sf_dir), layout=long_layout(spark, sf_dir)))


def chronological_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od.number_rows(long_series(spark, sf_dir), layout=long_layout(spark, sf_dir))


def dropna_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return frame.select("series_id", "ts", "y", "rn", "n_rows", "split")


def halo_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = prepare(long_series(spark, sf_dir), layout=long_layout(spark, sf_dir))
    return frame.select("series_id", "ts", "y", "rn", "n_rows", "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return me.scope_counts(frame, ["series_id", "split"])


def daily_order_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.chronological_split(daily_orders(spark, sf_dir)).select("series_id", "ts", "y", "rn", "split")


def seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hi.seasonal_naive(panel(spark, sf_dir), layout=panel_layout(spark, sf_dir))


# --- metrics -------------------------------------------------------------------


def metrics_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    measured = me.error_metrics(long_form(frame), ["series_id", "split", "model"])
    return rounded(me.relative_improvement(measured, "Seasonal Naive", ["series_id", "split"]))


def metrics_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = fl.in_days(naive(frame), dt.date(2000, 1, 1), dt.date(2000, 3, 31))
    return rounded(me.window_metrics(rows))


def empty_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = fl.in_days(naive(frame), dt.date(1900, 1, 1), dt.date(1900, 1, 2))
    return me.window_metrics(rows)


def forecast_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, layout = panel_frame(spark, sf_dir)
    return rounded(me.forecast_quality(naive(frame), ["series_id"], hot=layout.blocked))


def residual_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, layout = panel_frame(spark, sf_dir)
    rows = naive(sp.part(frame, "validation"))
    return rounded(me.residual_diagnostics(rows, ["series_id"], hot=layout.blocked))


def error_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = naive(frame).withColumns(fn.error_columns("y"))
    relative = fn.absolute_percentage_error(F.col("y"), F.col("prediction"))
    return rounded(
        rows.select(
            "series_id", "ts", "y", "prediction", "residual", "absolute_error", relative.alias("absolute_percentage_error")
        )
    )


def hot_group_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrowing path on one group that holds every event."""
    events = table(spark, sf_dir, "events").select(F.lit("all").alias("series_id"), "value")
    wanted = {"q50": 0.5, "q95": 0.95, "q99": 0.99}
    return rounded(qu.group_quantiles(events, ["series_id"], F.col("value"), wanted, hot=True, rows_per_task=1000))


def time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = me.time_bounds(panel(spark, sf_dir), by=["series_id"])
    return found.withColumns({name: F.col(name).cast("string") for name in ("min_date", "max_date")})


# --- anomalies -----------------------------------------------------------------


def detection(spark: SparkSession, sf_dir: str, staged: bool = False) -> Detection:
    frame, layout = panel_frame(spark, sf_dir)
    return detect_within(frame, "lag_168", layout=layout, staged=staged)


def fit_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detection(spark, sf_dir).thresholds.select("series_id", "quantile", "threshold"))


def score_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detection(spark, sf_dir).scored.select(*SCORED))


def panel_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rk.most_severe(detection(spark, sf_dir).anomalies).select(*SCORED))


def long_series_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run along one series that holds every row, through the block path."""
    layout = long_layout(spark, sf_dir)
    frame = prepare(long_series(spark, sf_dir), layout=layout)
    return rounded(detect_within(frame, "lag_168", layout=layout).anomalies.select(*SCORED))


def hourly_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = prepare(hourly(spark, sf_dir))
    found = detect(
        sp.part(frame, "validation"), sp.part(frame, "test"), quantile=0.90, calibrated_by="lag_168", scored_by="lag_168"
    )
    return rounded(found.anomalies.select(*SCORED))


def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(an.anomaly_counts(detection(spark, sf_dir).scored, ["series_id"]))


def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.col("severity_counts")
    summary = detection(spark, sf_dir, staged=True).summary
    return rounded(
        summary.select(
            "series_id",
            "method",
            "threshold_source",
            "threshold_quantile",
            "threshold_mw",
            "total_scored_rows",
            "anomaly_count",
            "anomaly_rate_percent",
            "spike_count",
            "drop_count",
            *[F.coalesce(level[s], F.lit(0)).alias(f"{s}_count") for s in ("moderate", "high", "critical")],
            F.size("top_anomalies").cast("bigint").alias("top_count"),
            F.get(F.col("top_anomalies"), F.lit(0))["datetime"].alias("top_datetime"),
            F.get(F.col("top_anomalies"), F.lit(0))["severity_score"].alias("top_score"),
            "threshold_fit_on_final_test",
        )
    )


def top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = an.top_anomaly_records(detection(spark, sf_dir).scored, ["series_id"], 10)
    return rounded(records.select("series_id", F.posexplode("top_anomalies").alias("place", "a")).select(
        "series_id", (F.col("place") + 1).alias("place"), "a.*"
    ))


def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.severity_counts(detection(spark, sf_dir).anomalies, ["series_id"])


def severity_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.severity_mix(detection(spark, sf_dir).anomalies)


def direction_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(an.direction_mix(detection(spark, sf_dir).anomalies, ["series_id"]))


def artifact_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    saved = naive(sp.part(frame, "validation", "test"))
    return al.alignment(saved, sp.part(frame, "test"))


def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each series' summary, as if the threshold of series with criticals were suspect."""
    scored = detection(spark, sf_dir).scored
    suspect = an.anomaly_counts(scored, ["series_id"]).select(
        "series_id", F.when(F.col("critical_count") > 0, True).alias("threshold_fit_on_final_test")
    )
    return integrity_status(suspect)


# --- monitoring view -------------------------------------------------------------


def date_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return fl.in_days(rows, dt.date(2024, 1, 5), dt.date(2024, 1, 11))


def membership_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = detection(spark, sf_dir).scored
    chosen = fl.members(fl.members(scored, "severity", ["high", "critical"]), "direction", ["spike"])
    return rounded(chosen.select(*SCORED))


def empty_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.members(detection(spark, sf_dir).scored, "severity", []).agg(F.count(F.lit(1)).alias("rows"))


def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = detection(spark, sf_dir).scored
    return me.scope_counts(fl.equals(scored, "direction", "drop"), ["series_id"])


def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = naive(sp.part(frame, "test")).withColumns(fn.error_columns("y"))
    return rounded(ds.histogram(rows))


def histogram_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = naive(frame).withColumns(fn.error_columns("y"))
    return rounded(ds.histogram(rows, by=["series_id"]))


def calibration_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return ds.calibration_bounds(naive(frame), by=["series_id"])


def rolling_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, layout = panel_frame(spark, sf_dir)
    rows = naive(frame).withColumns(fn.error_columns("y")).select("series_id", "ts", "absolute_error")
    return rounded(hi.rolling_mae(rows, layout=layout))


def halo_rolling_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_series(spark, sf_dir).select("series_id", "ts", F.abs("y").alias("absolute_error"))
    # Two-decimal values: at nine digits no mean lies halfway between two roundings.
    return rounded(hi.rolling_mae(rows, layout=long_layout(spark, sf_dir)), 9)


def worst_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    rows = naive(sp.part(frame, "validation")).withColumns(fn.error_columns("y"))
    return rk.worst_errors(rows, 10, ["series_id"]).select(
        "series_id", "ts", "y", "prediction", "residual", "absolute_error"
    )


def top_events_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = detection(spark, sf_dir).scored
    gravest = rk.most_severe(an.anomalies_only(scored), 20, ["series_id"])
    names = {"series_id": "series", "ts": "timestamp", "y": "actual", "prediction": "forecast", "severity_score": "score", "direction": "direction", "severity": "severity"}
    return fl.report(gravest, names, {"y": 1, "prediction": 1, "severity_score": 2})


def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(fn.label(F.col("event_type")).alias("label"), fn.iso_timestamp(fn.floor_hour(F.col("ts"))).alias("hour_text")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return rk.seeded_sample(naive(sp.part(frame, "test"))).select("series_id", "ts", "y", "prediction")


def monitoring_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default window of the view: the last 30 days of the test predictions."""
    found = detection(spark, sf_dir, staged=True)
    view = monitoring_view(found.scored, found.anomalies, layout=panel_layout(spark, sf_dir))
    counts, quality = view["counts"], view["quality"]
    return rounded(
        view["metrics"].select(
            "*",
            *[counts.select(c).scalar().alias(c) for c in counts.columns],
            *[quality.select(c).scalar().alias(c) for c in quality.columns],
        )
    )


def view(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The whole view of the default window, from predictions stored by day and their day rows."""
    cols = SeriesColumns()
    found = detection(spark, sf_dir, staged=True)
    predictions = spark.read.parquet(write_by_day(found.scored, scratch(spark, "by-day"), cols))
    events = spark.read.parquet(write_by_day(found.anomalies, scratch(spark, "events-by-day"), cols))
    return monitoring_view(
        predictions, events, layout=panel_layout(spark, sf_dir), daily=daily_tables(predictions, events, cols)
    )


def view_table(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """One table of the view, with these columns if any are named."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = view(spark, sf_dir)[name]
        return rounded(found.select(*columns) if columns else found)

    return run


def view_top_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The display names with underscores: SQL names ignore case and dislike blanks."""
    found = view(spark, sf_dir)["top_events"]
    return found.select(*(F.col(f"`{c}`").alias(f"shown_{c.lower().replace(' ', '_')}") for c in found.columns))


def stored_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of a folder without optional tables, and then with them: empty, then as written."""
    frame, _ = panel_frame(spark, sf_dir)
    found = detection(spark, sf_dir, staged=True)
    out = scratch(spark, "stored")
    write_table(found.scored.select("series_id", "ts", "y", "prediction"), f"{out}/predictions/final_test", "csv")
    record = run_metadata(frame, "y")
    save_record(record, f"{out}/metrics/final_test_metrics")
    save_record(record, f"{out}/metrics/anomaly_summary")
    counts = []
    for state in ("required only", "all"):
        shown = stored_view(spark, out, dt.date(1990, 1, 1), dt.date(2030, 1, 1))
        tables = {
            "predictions": shown.tables["predictions"],
            "anomalies": shown.tables["anomalies"],
            "comparison": shown.comparison,
            "importance": shown.importance,
            "backtest": shown.backtest,
        }
        numbers = [F.lit(t.count()).cast("long").alias(f"{n}_rows") for n, t in tables.items()]
        counts.append(record.select(F.lit(state).alias("state"), *numbers))
        write_table(found.anomalies, f"{out}/anomalies/final_test", "csv")
        compared = comparison_table(long_form(sp.part(frame, "validation")))
        zeros = [F.lit(0.0).alias(n) for n in ("train_seconds", "predict_seconds")]
        series = F.lit("all").alias("series_id")
        write_table(compared.select(series, "model", "MAE", "RMSE", "MAPE", *zeros), f"{out}/metrics/model_comparison_table")
        write_table(fold_results(frame, []).select(series, "fold", "model", "MAE", "RMSE", "MAPE", *zeros), f"{out}/metrics/backtest_results")
    return counts[0].unionByName(counts[1])


# --- backtest, comparison, selection ----------------------------------------------


def expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    member = sp.expanding_folds(sp.development(frame))
    return member.select("series_id", "ts", "rn", "fold", "role")


def fold_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    lengths = frame.groupBy("series_id").agg(F.max("n_development").alias("n_development"))
    return sp.fold_bounds(lengths)


def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return fold_row_counts(sp.development(frame), ["series_id"])


def fold_results(frame: DataFrame, by: list[str]) -> DataFrame:
    placed = sp.validation_fold(sp.development(frame))
    return fold_metrics(long_form(placed), by)


def backtest_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return rounded(fold_results(frame, ["series_id"]))


def backtest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    summary = me.backtest_summary(fold_results(frame, ["series_id"]), ["series_id", "model"])
    return rounded(rk.rank_models(summary, ["MAPE_mean"], ["series_id"]))


def backtest_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    record = backtest_record(fold_results(frame, []), frame)
    names = ["Seasonal Naive", *STAND_INS]
    return rounded(
        record.select(
            "n_folds",
            "min_train_fraction",
            "development_rows",
            "reserved_test_rows",
            "winner_by_mean_mape",
            *[F.col("mean_mape_by_model")[n].alias(f"mean_{i}") for i, n in enumerate(names)],
            *[F.col("mape_std_by_model")[n].alias(f"std_{i}") for i, n in enumerate(names)],
            "test_set_evaluated",
        )
    )


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    return rounded(comparison_table(long_form(sp.part(frame, "validation")), ["series_id"]))


def comparison_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    record = comparison_record(comparison_table(long_form(sp.part(frame, "validation"))))
    return rounded(
        record.select(
            F.col("models")["Seasonal Naive"]["MAE"].alias("naive_mae"),
            F.col("models")["lag_24"]["RMSE"].alias("lag_24_rmse"),
            "validation_winner",
            "winner_mape",
            "winner_relative_mape_improvement_percent",
            "test_set_evaluated",
        )
    )


def near_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    summary = me.backtest_summary(fold_results(frame, ["series_id"]), ["series_id", "model"])
    return rounded(rk.near_best(summary, "MAPE_mean", ["series_id"]).select("series_id", "model", "MAPE_mean"))


def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = panel_frame(spark, sf_dir)
    compared = comparison_table(long_form(sp.part(frame, "validation")), ["series_id"])
    summary = me.backtest_summary(fold_results(frame, ["series_id"]), ["series_id", "model"])
    chosen = select_model(compared, summary, ["series_id"], STAND_INS)
    return rounded(
        chosen.select(
            "series_id",
            "selected_model",
            "runner_up",
            F.col("selected_model_metrics.validation_mape").alias("selected_validation_mape"),
            F.col("selected_model_metrics.backtest_mean_mape").alias("selected_backtest_mape"),
            F.col("runner_up_metrics.validation_mape").alias("runner_up_validation_mape"),
            F.col("runner_up_metrics.backtest_mape_std").alias("runner_up_backtest_std"),
            "test_set_evaluated",
        )
    )


# --- fitted models (no SQL counterpart) ---------------------------------------------


def staged_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(panel(spark, sf_dir), layout=panel_layout(spark, sf_dir), staged=True)


def rf_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged_frame(spark, sf_dir)
    model = mo.fit_model(mo.random_forest(**SMALL_FOREST), sp.part(frame, "train"))
    return mo.predict(model, sp.part(frame, "test")).select("series_id", "ts", "y", "prediction")


def forest_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can know of a forest: which rows it scores, and that a mean of targets stays among them."""
    frame = staged_frame(spark, sf_dir)
    train = sp.part(frame, "train")
    scored = mo.predict(mo.fit_model(mo.random_forest(**SMALL_FOREST), train), sp.part(frame, "test"))
    low, high = (train.select(f("y").alias("bound")).scalar() for f in (F.min, F.max))
    return scored.select("series_id", "ts", "y", F.col("prediction").between(low, high).alias("within"))


def frozen_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frozen configuration, all 100 trees of depth 18, with scores among the targets."""
    frame = staged_frame(spark, sf_dir)
    train = sp.part(frame, "train")
    scored = mo.predict(mo.fit_model(mo.random_forest(), train), sp.part(frame, "test"))
    low, high = (train.select(f("y").alias("bound")).scalar() for f in (F.min, F.max))
    return scored.select("series_id", "ts", "y", F.col("prediction").between(low, high).alias("within"))


def boosting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that boosting scores, each with a finite number."""
    scored = gbt_forecast(spark, sf_dir)
    return scored.select("series_id", "ts", "y", fn.is_finite(F.col("prediction")).alias("finite"))


def importance_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances are shares of one over all features."""
    return feature_importance(spark, sf_dir).agg(
        F.count("*").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"),
    )


def gbt_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged_frame(spark, sf_dir)
    model = mo.fit_model(mo.gradient_boosting(), sp.part(frame, "train"))
    return mo.predict(model, sp.part(frame, "test")).select("series_id", "ts", "y", "prediction")


def calendar_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(fn.with_calendar(panel(spark, sf_dir)), "calendar")
    model = mo.fit_model(mo.calendar_forest(**SMALL_FOREST), rows)
    return mo.predict(model, rows).select("series_id", "ts", "y", "prediction")


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged_frame(spark, sf_dir)
    return analyze(frame, train_baseline(frame, estimator=mo.random_forest(**SMALL_FOREST)).model).importance


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged_frame(spark, sf_dir)
    forest = train_baseline(frame, estimator=mo.random_forest(**SMALL_FOREST)).model
    return compare_models(frame, forest, challenger=mo.gradient_boosting()).table


def model_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    makers = {
        CANDIDATE_MODELS[0]: lambda: mo.random_forest(**SMALL_FOREST),
        CANDIDATE_MODELS[1]: lambda: mo.gradient_boosting(),
    }
    return backtest(staged_frame(spark, sf_dir), estimators=makers, parallelism=4).results


def naive_only(metrics: DataFrame, *columns: str) -> DataFrame:
    """Metrics of the naive model, and whether those of the fitted ones are numbers: what SQL can know."""
    numbers = ["MAE", "RMSE", "MAPE"]
    naive = F.col("model") == "Seasonal Naive"
    finite = F.forall(F.array(*numbers), fn.is_finite)
    known = [F.when(naive, F.round(n, 6)).alias(n) for n in numbers]
    return metrics.select(*columns, "model", *known, finite.alias("finite"))


def backtest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fold and model of the fitted backtest, with the naive model's numbers."""
    return naive_only(model_backtest(spark, sf_dir), "fold")


def comparison_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three compared models, with the naive model's numbers, and a rank for each."""
    table = model_comparison(spark, sf_dir)
    wrong = table.alias("a").join(table.alias("b"), F.expr("a.rank < b.rank AND a.MAPE > b.MAPE")).count()
    return naive_only(table).withColumn("ranked_by_mape", F.lit(wrong == 0))


def final_evaluation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final record without the forest's numbers; its rule and the naive numbers are SQL's."""
    record = forest_final_evaluation(spark, sf_dir)
    base, own = F.col("seasonal_naive.MAPE"), F.col("random_forest.MAPE")
    return record.select(
        "selected_model",
        "training_scope",
        "development_rows",
        "test_rows",
        *(F.round(f"seasonal_naive.{n}", 6).alias(f"naive_{n}") for n in ("MAE", "RMSE", "MAPE")),
        (F.round("relative_mape_improvement_percent", 6) == F.round((base - own) / base * 100, 6)).alias("improvement_holds"),
        "test_set_evaluated",
    )


def forest_anomaly_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of the fitted run, and how many break a rule of flag, direction, score or severity."""
    found = forest_detection(spark, sf_dir)
    limits = found.thresholds.select("series_id", "threshold")
    rows = found.scored.join(limits, "series_id")
    size = F.abs(F.col("y") - F.col("prediction"))
    sign = F.when(F.col("residual") > 0, "spike").when(F.col("residual") < 0, "drop").otherwise("neutral")
    grade = F.expr(
        "CASE WHEN NOT is_anomaly THEN 'normal' WHEN severity_score < 1.5 THEN 'moderate' "
        "WHEN severity_score < 2.0 THEN 'high' ELSE 'critical' END"
    )
    held = found.scored.where("is_anomaly").count() == found.anomalies.count()
    return rows.groupBy("series_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("is_anomaly") != (size > F.col("threshold"))).alias("wrong_flags"),
        F.count_if(F.col("direction") != sign).alias("wrong_directions"),
        F.count_if(F.abs(F.col("severity_score") * F.col("threshold") - size) > 1e-6).alias("wrong_scores"),
        F.count_if(F.col("severity") != grade).alias("wrong_severities"),
        F.lit(held).alias("anomalies_are_the_flagged"),
    )


def calendar_forest_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, with a score among the targets."""
    scored = calendar_forest(spark, sf_dir)
    low, high = (scored.select(f("y").alias("bound")).scalar() for f in (F.min, F.max))
    return scored.select("series_id", "ts", "y", F.col("prediction").between(low, high).alias("within"))


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest and a boosting saved, loaded and compared with themselves, row by row."""
    frame = staged_frame(spark, sf_dir)
    out = []
    for name, estimator in (
        ("forest", mo.random_forest(**SMALL_FOREST)),
        ("boosting", mo.gradient_boosting(maxIter=5)),
    ):
        model = mo.fit_model(estimator, sp.part(frame, "train"))
        loaded = load_model(spark, save_model(model, scratch(spark, name)))
        both = mo.predict(model, sp.part(frame, "test"), "saved")
        both = mo.predict(loaded, both.select("*"), "loaded")
        differ = ~F.col("saved").eqNullSafe(F.col("loaded"))
        out.append(both.agg(F.lit(name).alias("model"), F.count("*").alias("rows"), F.count_if(differ).alias("differing")))
    return out[0].unionByName(out[1])


def boosting_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stopping rule checked on the stored holdout losses with windows over the rounds.

    Wrong rounds are those after which the rule says stop though a later one is there, or
    does not though none is, and those kept beyond the least loss or left out before it.
    """
    estimator = mo.gradient_boosting()
    train = sp.part(staged_frame(spark, sf_dir), "train")
    found = mo.boosted(estimator.getStages()[1], stage(mo.assembled(estimator, train), "vectors"))
    curve = stage(found.table(spark), "losses")
    rounds = Window.orderBy("round")
    last = Window.partitionBy()
    recent = F.min("loss").over(rounds.rowsBetween(1 - bo.PATIENCE, 0))
    before = F.lag("loss", bo.PATIENCE).over(rounds)
    ruled = curve.select(
        "*",
        (before.isNotNull() & (recent >= before - bo.TOLERANCE)).alias("stop"),
        (F.col("round") == F.max("round").over(last)).alias("last"),
        F.min(F.struct("loss", "round")).over(last).alias("least"),
    )
    most = F.col("round") == mo.BOOSTING["maxIter"]
    return ruled.agg(
        F.count_if((F.col("stop") != F.col("last")) & ~(F.col("last") & most)).alias("wrong_stops"),
        F.count_if(F.col("kept") != (F.col("round") <= F.col("least.round"))).alias("wrongly_kept"),
        F.lit(len(found.model.trees) == found.rounds.best).alias("cut_to_best"),
    )


def forest_final_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged_frame(spark, sf_dir)
    selection = spark.sql("SELECT 'Random Forest' AS selected_model, false AS test_set_evaluated")
    return final_evaluation(frame, selection, estimator=mo.random_forest(**SMALL_FOREST)).record


def forest_detection(spark: SparkSession, sf_dir: str) -> Detection:
    frame = staged_frame(spark, sf_dir)
    selection = spark.sql("SELECT 'Random Forest' AS selected_model, false AS test_set_evaluated")
    final = final_evaluation(frame, selection, estimator=mo.random_forest(**SMALL_FOREST))
    return calibrate_and_detect(
        frame, final.predictions, estimator=mo.random_forest(**SMALL_FOREST), layout=panel_layout(spark, sf_dir)
    )


def forest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_detection(spark, sf_dir).anomalies


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_series": load_series_file,
    "load_csv": load_csv,
    "load_mixed_csv": load_mixed_csv,
    "load_dedup": load_dedup,
    "predictions_round_trip": predictions_round_trip,
    "run_record_round_trip": run_record_round_trip,
    "record_indented_json": record_indented_json,
    "calendar_features": calendar_features,
    "forecast_features": forecast_features,
    "panel_features": panel_features,
    "halo_features": halo_features,
    "chronological_position": chronological_position,
    "dropna_split": dropna_split,
    "halo_split": halo_split,
    "split_counts": split_counts,
    "daily_order_split": daily_order_split,
    "seasonal_naive": seasonal_naive,
    "metrics_by_model": metrics_by_model,
    "metrics_window": metrics_window,
    "empty_window": empty_window,
    "r2_bias_quantiles": forecast_quality,
    "residual_diagnostics": residual_diagnostics,
    "error_columns": error_columns,
    "hot_group_quantiles": hot_group_quantiles,
    "time_bounds": time_bounds,
    "fit_threshold": fit_threshold,
    "score_anomalies": score_anomalies,
    "panel_anomalies": panel_anomalies,
    "long_series_anomalies": long_series_anomalies,
    "hourly_anomalies": hourly_anomalies,
    "anomaly_counts": anomaly_counts,
    "anomaly_summary": anomaly_summary,
    "top_anomalies": top_anomalies,
    "severity_counts": severity_counts,
    "severity_mix_dense": severity_mix,
    "direction_mix": direction_mix,
    "artifact_alignment": artifact_alignment,
    "integrity_status": integrity,
    "date_window_filter": date_window_filter,
    "membership_filter": membership_filter,
    "empty_selection": empty_selection,
    "equality_filter": equality_filter,
    "residual_histogram": residual_histogram,
    "histogram_by_series": histogram_by_series,
    "calibration_bounds": calibration_bounds,
    "rolling_mae_7d": rolling_mae,
    "halo_rolling_mae": halo_rolling_mae,
    "worst_errors": worst_errors,
    "top_events_report": top_events_report,
    "label_text": label_text,
    "seeded_sample": seeded_sample,
    "monitoring_metrics": monitoring_metrics,
    "view_predictions": view_table("predictions", "series_id", "ts", "y", "prediction", "residual", "absolute_error"),
    "view_anomalies": view_table("anomalies", *SCORED),
    "view_metrics": view_table("metrics"),
    "view_quality": view_table("quality"),
    "view_severity_mix": view_table("severity_mix"),
    "view_direction_mix": view_table("direction_mix"),
    "view_histogram": view_table("histogram"),
    "view_rolling_mae": view_table("rolling_mae", "series_id", "ts", "absolute_error", "rolling_mae_7d"),
    "view_sample": view_table("sample", "series_id", "ts", "y", "prediction"),
    "view_calibration_bounds": view_table("calibration_bounds"),
    "view_top_events": view_top_events,
    "view_counts": view_table("counts"),
    "stored_artifacts": stored_artifacts,
    "expanding_folds": expanding_folds,
    "fold_bounds": fold_bounds,
    "fold_counts": fold_counts,
    "backtest_naive": backtest_naive,
    "backtest_summary": backtest_summary,
    "backtest_record": backtest_run_record,
    "comparison_table": comparison,
    "comparison_record": comparison_run_record,
    "near_ties": near_ties,
    "select_model": model_selection,
    "rf_forecast": rf_forecast,
    "gbt_forecast": gbt_forecast,
    "forest_bounds": forest_bounds,
    "frozen_forest": frozen_forest,
    "boosting_keys": boosting_keys,
    "importance_total": importance_total,
    "calendar_forest": calendar_forest,
    "feature_importance": feature_importance,
    "model_comparison": model_comparison,
    "model_backtest": model_backtest,
    "final_evaluation": forest_final_evaluation,
    "forest_anomalies": forest_anomalies,
    "backtest_keys": backtest_keys,
    "comparison_keys": comparison_keys,
    "final_evaluation_counts": final_evaluation_counts,
    "forest_anomaly_rules": forest_anomaly_rules,
    "calendar_forest_bounds": calendar_forest_bounds,
    "model_round_trip": model_round_trip,
    "boosting_rounds": boosting_rounds,
}
