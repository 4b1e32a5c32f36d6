"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from loadcast.operators.ranking import SAMPLE_ROWS, SAMPLE_SEED

HOURLY = """
series AS (
  SELECT 'all' AS series_id, date_trunc('hour', ts) AS ts, round(sum(value), 2) AS y
  FROM events GROUP BY 1, 2)"""

HOURLY_BY_TYPE = """
series AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, round(sum(value), 2) AS y
  FROM events GROUP BY 1, 2)"""

PANEL = """
series AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts,
         sum(l_quantity) AS y
  FROM lineitem GROUP BY 1, 2)"""

LONG_SERIES = """
series AS (SELECT 'all' AS series_id, ts, value AS y FROM events)"""

OVER = "OVER (PARTITION BY series_id ORDER BY ts"
DAY = OVER + " ROWS BETWEEN 47 PRECEDING AND 24 PRECEDING)"
WEEK = OVER + " ROWS BETWEEN 191 PRECEDING AND 24 PRECEDING)"

CALENDAR = """
  CAST(extract('hour' FROM ts) AS INTEGER) AS hour,
  CAST(extract('isodow' FROM ts) - 1 AS INTEGER) AS day_of_week,
  CAST(extract('month' FROM ts) AS INTEGER) AS month,
  CAST(extract('doy' FROM ts) AS INTEGER) AS day_of_year,
  CAST(CASE WHEN extract('isodow' FROM ts) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"""

FEATURES = f"""
features AS (
  SELECT series_id, ts, y, {CALENDAR},
    lag(y, 24) {OVER}) AS lag_24, lag(y, 48) {OVER}) AS lag_48, lag(y, 168) {OVER}) AS lag_168,
    CASE WHEN count(y) {DAY} = 24 THEN avg(y) {DAY} END AS rolling_mean_24,
    CASE WHEN count(y) {DAY} = 24 THEN stddev_samp(y) {DAY} END AS rolling_std_24,
    CASE WHEN count(y) {WEEK} = 168 THEN avg(y) {WEEK} END AS rolling_mean_168
  FROM series)"""

FRAME = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS rn,
         count(*) OVER (PARTITION BY series_id) AS n_rows
  FROM features
  WHERE y IS NOT NULL AND lag_24 IS NOT NULL AND lag_48 IS NOT NULL AND lag_168 IS NOT NULL
    AND rolling_mean_24 IS NOT NULL AND rolling_std_24 IS NOT NULL AND rolling_mean_168 IS NOT NULL),
cuts AS (
  SELECT *, CAST(floor(n_rows * 0.70::DOUBLE) AS BIGINT) AS train_end,
         CAST(floor(n_rows * 0.15::DOUBLE) AS BIGINT) AS validation_rows
  FROM numbered),
frame AS (
  SELECT *, train_end + validation_rows AS n_development,
    CASE WHEN rn < train_end THEN 'train'
         WHEN rn < train_end + validation_rows THEN 'validation' ELSE 'test' END AS split
  FROM cuts)"""

FOLDS = """
shape AS (
  SELECT *, CAST(floor(n_development * 0.5::DOUBLE) AS BIGINT) AS first_row,
         (n_development - CAST(floor(n_development * 0.5::DOUBLE) AS BIGINT)) // 4 AS fold_size
  FROM frame WHERE split <> 'test'),
placed AS (
  SELECT *, CASE WHEN rn >= first_row
                 THEN least(4, (rn - first_row) // fold_size + 1) END AS fold
  FROM shape)"""

MODELS = """
    (SELECT *, 'Seasonal Naive' AS model, lag_168 AS prediction FROM {0}
     UNION ALL SELECT *, 'lag_24' AS model, lag_24 AS prediction FROM {0}
     UNION ALL SELECT *, 'rolling_mean_24' AS model, rolling_mean_24 AS prediction FROM {0})"""

METRICS = """avg(abs(y - prediction)) AS MAE, sqrt(avg((y - prediction) * (y - prediction))) AS RMSE,
    coalesce(avg(CASE WHEN y <> 0 THEN abs((y - prediction) / y) END) * 100, 'nan'::DOUBLE) AS MAPE"""

ROUNDED_METRICS = "round(MAE, 6) AS MAE, round(RMSE, 6) AS RMSE, round(MAPE, 6) AS MAPE"


def with_frame(source: str, *more: str) -> str:
    return "WITH " + ",".join([source, FEATURES, FRAME, *more])


def scoring(quantile: str = "0.99") -> str:
    return f"""
thresholds AS (
  SELECT series_id, {quantile}::DOUBLE AS quantile,
         quantile_cont(abs(y - lag_168), {quantile}) AS threshold
  FROM frame WHERE split = 'validation' GROUP BY series_id),
scored AS (
  SELECT f.series_id, ts, y, lag_168 AS prediction, y - lag_168 AS residual,
    abs(y - lag_168) AS absolute_residual, abs(y - lag_168) > threshold AS is_anomaly,
    abs(y - lag_168) / threshold AS severity_score,
    CASE WHEN y - lag_168 > 0 THEN 'spike' WHEN y - lag_168 < 0 THEN 'drop' ELSE 'neutral' END AS direction,
    CASE WHEN NOT abs(y - lag_168) > threshold THEN 'normal'
         WHEN abs(y - lag_168) / threshold < 1.5 THEN 'moderate'
         WHEN abs(y - lag_168) / threshold < 2.0 THEN 'high' ELSE 'critical' END AS severity
  FROM frame f JOIN thresholds t USING (series_id) WHERE split = 'test'),
anomalies AS (SELECT * FROM scored WHERE is_anomaly)"""


SCORED = """series_id, ts, round(y, 6) AS y, round(prediction, 6) AS prediction, round(residual, 6) AS residual,
  round(absolute_residual, 6) AS absolute_residual, is_anomaly, round(severity_score, 6) AS severity_score,
  direction, severity"""

FEATURE_LIST = """hour, day_of_week, month, day_of_year, is_weekend, round(lag_24, 6) AS lag_24,
  round(lag_48, 6) AS lag_48, round(lag_168, 6) AS lag_168, round(rolling_mean_24, 6) AS rolling_mean_24,
  round(rolling_std_24, 6) AS rolling_std_24, round(rolling_mean_168, 6) AS rolling_mean_168"""

FEATURE_QUERY = f"SELECT series_id, ts, round(y, 6) AS y, {FEATURE_LIST} FROM features"
SPLIT_QUERY = "SELECT series_id, ts, y, rn, n_rows, split FROM frame"
PANEL_FRAME = with_frame(PANEL)
PANEL_SCORED = with_frame(PANEL, scoring())
PANEL_FOLDS = with_frame(PANEL, FOLDS)

FOLD_METRICS = f"""
fold_metrics AS (
  SELECT series_id, fold, model, {METRICS}, 0.0::DOUBLE AS train_seconds, 0.0::DOUBLE AS predict_seconds
  FROM {MODELS.format("placed")} WHERE fold IS NOT NULL GROUP BY series_id, fold, model),
summary AS (
  SELECT series_id, model, avg(MAE) AS MAE_mean, stddev_samp(MAE) AS MAE_std, avg(RMSE) AS RMSE_mean,
    stddev_samp(RMSE) AS RMSE_std, avg(MAPE) AS MAPE_mean, stddev_samp(MAPE) AS MAPE_std,
    stddev_pop(MAPE) AS MAPE_variability, avg(train_seconds) AS train_seconds_mean,
    avg(predict_seconds) AS predict_seconds_mean
  FROM fold_metrics GROUP BY series_id, model)"""

COMPARED = f"""
measured AS (
  SELECT series_id, model, {METRICS} FROM {MODELS.format("frame")} WHERE split = 'validation'
  GROUP BY series_id, model)"""

IMPROVEMENT = """(max(CASE WHEN model = 'Seasonal Naive' THEN MAPE END) OVER (PARTITION BY {0}) - MAPE)
    / nullif(max(CASE WHEN model = 'Seasonal Naive' THEN MAPE END) OVER (PARTITION BY {0}), 0) * 100"""


def histogram(rows: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    window = f"PARTITION BY {by}" if by else ""
    return f"""
ranged AS (
  SELECT {key}residual, min(residual) OVER ({window}) AS low, max(residual) OVER ({window}) AS high FROM {rows}),
binned AS (
  SELECT {key}low, high, CAST(least(54, coalesce(floor((residual - low) / nullif((high - low) / 55, 0)), 0)) AS INTEGER) AS bin
  FROM ranged)
SELECT {key}bin, round(low + bin * ((high - low) / 55), 6) AS bin_start,
  round(low + (bin + 1) * ((high - low) / 55), 6) AS bin_end, count(*) AS count
FROM binned GROUP BY {key}low, high, bin"""


RESIDUALS = """
residuals AS (SELECT *, lag_168 AS prediction, y - lag_168 AS residual, abs(y - lag_168) AS absolute_error FROM frame)"""

VIEW = PANEL_SCORED + """,
bounds AS (SELECT CAST(max(ts) AS DATE) AS last, greatest(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) - 29) AS first FROM scored),
shown AS (SELECT s.*, absolute_residual AS absolute_error FROM scored s, bounds WHERE ts >= first AND ts < last + INTERVAL 1 DAY),
events_shown AS (SELECT * FROM shown WHERE is_anomaly)"""

SAMPLE = f"""SELECT series_id, ts, y, prediction FROM shown
  ORDER BY md5(concat_ws('|', series_id, CAST(ts AS VARCHAR), '{SAMPLE_SEED}')), series_id, ts LIMIT {SAMPLE_ROWS}"""

ORACLES: dict[str, str] = {
    "view_predictions": VIEW + """
      SELECT series_id, ts, round(y, 6) AS y, round(prediction, 6) AS prediction, round(residual, 6) AS residual,
        round(absolute_error, 6) AS absolute_error FROM shown""",
    "view_anomalies": VIEW + f"SELECT {SCORED} FROM events_shown",
    "view_metrics": VIEW + f"""
      SELECT round(MAE, 6) AS mae, round(RMSE, 6) AS rmse, round(MAPE, 6) AS mape FROM (SELECT {METRICS} FROM shown)""",
    "view_quality": VIEW + """
      SELECT round(1 - sum(residual * residual) / (count(*) * var_pop(y)), 6) AS r2, round(avg(residual), 6) AS bias,
        round(quantile_cont(absolute_error, 0.5), 6) AS median_absolute_error,
        round(quantile_cont(absolute_error, 0.95), 6) AS p95_absolute_error FROM shown""",
    "view_severity_mix": VIEW + """
      SELECT CAST(l.level AS INTEGER) AS level, l.severity, count(a.series_id) AS count
      FROM (VALUES (1, 'moderate'), (2, 'high'), (3, 'critical')) l(level, severity)
      LEFT JOIN events_shown a USING (severity) GROUP BY l.level, l.severity""",
    "view_direction_mix": VIEW + """,
      counts AS (SELECT count(*) FILTER (direction = 'spike') AS spike_count,
                        count(*) FILTER (direction = 'drop') AS drop_count FROM events_shown)
      SELECT spike_count, drop_count,
        round(coalesce(100.0::DOUBLE * spike_count / nullif(spike_count + drop_count, 0), 0), 6) AS spike_pct,
        round(coalesce(100.0::DOUBLE * drop_count / nullif(spike_count + drop_count, 0), 0), 6) AS drop_pct,
        CASE WHEN spike_count > drop_count THEN 'SPIKES' WHEN drop_count > spike_count THEN 'DROPS'
             ELSE 'BALANCED' END AS dominant_direction FROM counts""",
    "view_histogram": VIEW + ", " + histogram("shown"),
    "view_rolling_mae": VIEW + f"""
      SELECT series_id, ts, round(absolute_error, 6) AS absolute_error,
        round(CASE WHEN count(absolute_error) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) >= 24
          THEN avg(absolute_error) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END, 6) AS rolling_mae_7d
      FROM shown""",
    "view_sample": VIEW + f"SELECT series_id, ts, round(y, 6) AS y, round(prediction, 6) AS prediction FROM ({SAMPLE})",
    "view_calibration_bounds": VIEW + f"""
      SELECT round(least(min(y), min(prediction)), 6) AS min_value, round(greatest(max(y), max(prediction)), 6) AS max_value
      FROM ({SAMPLE})""",
    "view_top_events": VIEW + """
      SELECT ts AS shown_timestamp, round_even(y, 1) AS shown_actual_mw, round_even(prediction, 1) AS shown_forecast_mw,
        round_even(residual, 1) AS shown_residual_mw, round_even(severity_score, 2) AS shown_severity_score,
        direction AS shown_direction, severity AS shown_severity
      FROM events_shown ORDER BY severity_score DESC, ts LIMIT 20""",
    "view_counts": VIEW + """
      SELECT count(*) FILTER (direction = 'spike') AS spike_count, count(*) FILTER (direction = 'drop') AS drop_count,
        count(*) FILTER (severity = 'critical') AS critical_count FROM events_shown""",
    "stored_artifacts": with_frame(PANEL, scoring(), FOLDS) + """
      SELECT state, (SELECT count(*) FROM scored) AS predictions_rows,
        CASE WHEN state = 'all' THEN (SELECT count(*) FROM anomalies) ELSE 0 END AS anomalies_rows,
        CASE WHEN state = 'all' THEN 3 ELSE 0 END::BIGINT AS comparison_rows, 0::BIGINT AS importance_rows,
        CASE WHEN state = 'all' THEN (SELECT 3 * count(DISTINCT fold) FROM placed WHERE fold IS NOT NULL) ELSE 0 END AS backtest_rows
      FROM (VALUES ('required only'), ('all')) v(state)""",
    "load_series": """
      SELECT o_orderstatus, o_orderdate, o_totalprice, o_orderkey, o_custkey, o_orderpriority FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderdate
                                     ORDER BY o_totalprice NULLS LAST, o_orderkey) AS place FROM orders)
      WHERE place = 1""",
    "load_dedup": """
      SELECT series_id, ts, y FROM (
        SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, value AS y,
          row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY value NULLS LAST) AS place
        FROM events) WHERE place = 1""",
    "predictions_round_trip": PANEL_FRAME + """
      SELECT series_id, ts, y, lag_168 AS prediction, y - lag_168 AS residual, abs(y - lag_168) AS absolute_error
      FROM frame WHERE split = 'test'""",
    "run_record_round_trip": PANEL_FRAME + """
      SELECT 'RandomForestRegressor' AS model_type, 'y' AS target_column,
        'hour,day_of_week,month,day_of_year,is_weekend,lag_24,lag_48,lag_168,rolling_mean_24,rolling_std_24,rolling_mean_168'
          AS feature_columns,
        count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'validation') AS validation_rows,
        count(*) FILTER (split = 'test') AS test_rows, false AS test_set_evaluated, 42::INTEGER AS random_state
      FROM frame""",
    "seeded_sample": PANEL_FRAME + f"""
      SELECT series_id, ts, y, lag_168 AS prediction FROM frame WHERE split = 'test'
      ORDER BY md5(concat_ws('|', series_id, CAST(ts AS VARCHAR), '{SAMPLE_SEED}')), series_id, ts LIMIT {SAMPLE_ROWS}""",
    "load_csv": """
      SELECT o_orderstatus, o_orderdate, min(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END) AS o_totalprice
      FROM orders GROUP BY 1, 2""",
    "load_mixed_csv": """
      SELECT o_orderstatus, o_orderdate, o_totalprice, CASE WHEN o_orderkey % 3 < 2 THEN o_custkey END AS o_custkey FROM orders""",
    "forest_bounds": PANEL_FRAME + "SELECT series_id, ts, y, true AS within FROM frame WHERE split = 'test'",
    "frozen_forest": PANEL_FRAME + "SELECT series_id, ts, y, true AS within FROM frame WHERE split = 'test'",
    "boosting_keys": PANEL_FRAME + "SELECT series_id, ts, y, true AS finite FROM frame WHERE split = 'test'",
    "importance_total": "SELECT 11::BIGINT AS features, 1.0::DOUBLE AS total, 0::BIGINT AS negative FROM (SELECT 1 FROM lineitem LIMIT 1)",
    "backtest_keys": with_frame(PANEL, FOLDS) + f""",
      naive AS (
        SELECT fold, {METRICS} FROM {MODELS.format("placed")} WHERE fold IS NOT NULL AND model = 'Seasonal Naive' GROUP BY fold)
      SELECT CAST(fold AS INTEGER) AS fold, 'Seasonal Naive' AS model, {ROUNDED_METRICS}, true AS finite FROM naive
      UNION ALL SELECT CAST(fold AS INTEGER), model, NULL, NULL, NULL, true
      FROM naive, (VALUES ('Random Forest'), ('HistGradientBoosting')) v(model)""",
    "comparison_keys": PANEL_FRAME + f""",
      naive AS (SELECT {METRICS} FROM {MODELS.format("frame")} WHERE split = 'validation' AND model = 'Seasonal Naive')
      SELECT 'Seasonal Naive' AS model, {ROUNDED_METRICS}, true AS finite, true AS ranked_by_mape FROM naive
      UNION ALL SELECT model, NULL, NULL, NULL, true, true
      FROM naive, (VALUES ('Random Forest'), ('HistGradientBoosting')) v(model)""",
    "final_evaluation_counts": PANEL_FRAME + f""",
      naive AS (SELECT {METRICS} FROM {MODELS.format("frame")} WHERE split = 'test' AND model = 'Seasonal Naive')
      SELECT 'Random Forest' AS selected_model, 'train_plus_validation' AS training_scope,
        (SELECT count(*) FROM frame WHERE split <> 'test') AS development_rows,
        (SELECT count(*) FROM frame WHERE split = 'test') AS test_rows,
        round(MAE, 6) AS naive_MAE, round(RMSE, 6) AS naive_RMSE, round(MAPE, 6) AS naive_MAPE,
        true AS improvement_holds, true AS test_set_evaluated FROM naive""",
    "forest_anomaly_rules": PANEL_FRAME + """
      SELECT series_id, count(*) AS rows, 0::BIGINT AS wrong_flags, 0::BIGINT AS wrong_directions,
        0::BIGINT AS wrong_scores, 0::BIGINT AS wrong_severities, true AS anomalies_are_the_flagged
      FROM frame WHERE split = 'test' GROUP BY series_id""",
    "calendar_forest_bounds": f"WITH {PANEL} SELECT series_id, ts, y, true AS within FROM series",
    "model_round_trip": PANEL_FRAME + """
      SELECT model, count(*) AS rows, 0::BIGINT AS differing
      FROM frame, (VALUES ('forest'), ('boosting')) v(model) WHERE split = 'test' GROUP BY model""",
    "boosting_rounds": "SELECT 0::BIGINT AS wrong_stops, 0::BIGINT AS wrongly_kept, true AS cut_to_best FROM (SELECT 1 FROM lineitem LIMIT 1)",
    "record_indented_json": PANEL_FRAME + """
      SELECT 'RandomForestRegressor' AS model_type, 'y' AS target_column,
        count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows
      FROM frame""",
    "calendar_features": f"WITH {HOURLY_BY_TYPE} SELECT series_id, ts, y, {CALENDAR} FROM series",
    "forecast_features": f"WITH {HOURLY}, {FEATURES} {FEATURE_QUERY}",
    "panel_features": f"WITH {PANEL}, {FEATURES} {FEATURE_QUERY}",
    "halo_features": f"WITH {LONG_SERIES}, {FEATURES} {FEATURE_QUERY}",
    "chronological_position": f"""WITH {LONG_SERIES}
      SELECT series_id, ts, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS rn,
        count(*) OVER (PARTITION BY series_id) AS n_rows FROM series""",
    "dropna_split": PANEL_FRAME + SPLIT_QUERY,
    "halo_split": with_frame(LONG_SERIES) + SPLIT_QUERY,
    "split_counts": PANEL_FRAME + "SELECT series_id, split, count(*) AS rows FROM frame GROUP BY series_id, split",
    "daily_order_split": """
      WITH daily AS (SELECT 'all' AS series_id, o_orderdate AS ts, round(sum(o_totalprice), 2) AS y
                     FROM orders GROUP BY o_orderdate),
      placed AS (SELECT *, row_number() OVER (ORDER BY ts) - 1 AS rn, count(*) OVER () AS n FROM daily)
      SELECT series_id, ts, y, rn,
        CASE WHEN rn < CAST(floor(n * 0.70::DOUBLE) AS BIGINT) THEN 'train'
             WHEN rn < CAST(floor(n * 0.70::DOUBLE) AS BIGINT) + CAST(floor(n * 0.15::DOUBLE) AS BIGINT)
             THEN 'validation' ELSE 'test' END AS split FROM placed""",
    "seasonal_naive": f"WITH {PANEL} SELECT series_id, ts, y, lag(y, 168) {OVER}) AS prediction FROM series",
    "metrics_by_model": PANEL_FRAME + f"""
      SELECT series_id, split, model, {ROUNDED_METRICS},
        round({IMPROVEMENT.format("series_id, split")}, 6) AS mape_improvement_percent
      FROM (SELECT series_id, split, model, {METRICS} FROM {MODELS.format("frame")} GROUP BY series_id, split, model)""",
    "metrics_window": PANEL_FRAME + f"""
      SELECT round(MAE, 6) AS mae, round(RMSE, 6) AS rmse, round(MAPE, 6) AS mape FROM (
        SELECT {METRICS} FROM (SELECT y, lag_168 AS prediction FROM frame
          WHERE ts >= TIMESTAMP '2000-01-01' AND ts < TIMESTAMP '2000-04-01'))""",
    "empty_window": """
      SELECT coalesce(sum(l_quantity), 'nan'::DOUBLE) AS mae, coalesce(sum(l_quantity), 'nan'::DOUBLE) AS rmse,
        coalesce(sum(l_quantity), 'nan'::DOUBLE) AS mape
      FROM lineitem WHERE l_shipdate < TIMESTAMP '1900-01-03'""",
    "r2_bias_quantiles": PANEL_FRAME + f""", {RESIDUALS}
      SELECT series_id,
        round(1 - sum(residual * residual) / (count(*) * var_pop(y)), 6) AS r2, round(avg(residual), 6) AS bias,
        round(quantile_cont(absolute_error, 0.5), 6) AS median_absolute_error,
        round(quantile_cont(absolute_error, 0.95), 6) AS p95_absolute_error
      FROM residuals GROUP BY series_id""",
    "residual_diagnostics": PANEL_FRAME + f""", {RESIDUALS}
      SELECT series_id, count(*) AS rows, round(avg(residual), 6) AS mean_residual,
        round(quantile_cont(residual, 0.5), 6) AS median_residual, round(stddev_samp(residual), 6) AS residual_std,
        round(avg(absolute_error), 6) AS mean_absolute_error,
        round(quantile_cont(absolute_error, 0.5), 6) AS median_absolute_error,
        round(quantile_cont(absolute_error, 0.95), 6) AS p95_absolute_error,
        round(max(absolute_error), 6) AS max_absolute_error,
        round(avg(absolute_error / nullif(abs(y), 0)) * 100, 6) AS mean_absolute_percentage_error
      FROM residuals WHERE split = 'validation' GROUP BY series_id""",
    "error_columns": PANEL_FRAME + f""", {RESIDUALS}
      SELECT series_id, ts, y, prediction, round(residual, 6) AS residual, round(absolute_error, 6) AS absolute_error,
        round(absolute_error / nullif(abs(y), 0) * 100, 6) AS absolute_percentage_error FROM residuals""",
    "hot_group_quantiles": """
      SELECT 'all' AS series_id, round(quantile_cont(value, 0.5), 6) AS q50,
        round(quantile_cont(value, 0.95), 6) AS q95, round(quantile_cont(value, 0.99), 6) AS q99 FROM events""",
    "time_bounds": f"""WITH {PANEL}
      SELECT series_id, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS min_date,
        CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS max_date FROM series GROUP BY series_id""",
    "fit_threshold": PANEL_SCORED + "SELECT series_id, quantile, round(threshold, 6) AS threshold FROM thresholds",
    "score_anomalies": PANEL_SCORED + f"SELECT {SCORED} FROM scored",
    "panel_anomalies": PANEL_SCORED + f"SELECT {SCORED} FROM anomalies",
    "long_series_anomalies": with_frame(LONG_SERIES, scoring()) + f"SELECT {SCORED} FROM anomalies",
    "hourly_anomalies": with_frame(HOURLY, scoring("0.90")) + f"SELECT {SCORED} FROM anomalies",
    "anomaly_counts": PANEL_SCORED + """
      SELECT series_id, count(*) AS total_scored_rows, count(*) FILTER (is_anomaly) AS anomaly_count,
        round(count(*) FILTER (is_anomaly) / count(*)::DOUBLE * 100, 6) AS anomaly_rate_percent,
        count(*) FILTER (is_anomaly AND direction = 'spike') AS spike_count,
        count(*) FILTER (is_anomaly AND direction = 'drop') AS drop_count,
        count(*) FILTER (severity = 'critical') AS critical_count
      FROM scored GROUP BY series_id""",
    "anomaly_summary": PANEL_SCORED + """,
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY severity_score DESC, ts) AS place
                              FROM anomalies) WHERE place = 1),
      counts AS (
        SELECT series_id, count(*) AS total_scored_rows, count(*) FILTER (is_anomaly) AS anomaly_count,
          count(*) FILTER (is_anomaly AND direction = 'spike') AS spike_count,
          count(*) FILTER (is_anomaly AND direction = 'drop') AS drop_count,
          count(*) FILTER (severity = 'moderate') AS moderate_count, count(*) FILTER (severity = 'high') AS high_count,
          count(*) FILTER (severity = 'critical') AS critical_count
        FROM scored GROUP BY series_id)
      SELECT c.series_id, 'absolute_forecast_residual_quantile' AS method,
        'unseen_validation_residuals' AS threshold_source, t.quantile AS threshold_quantile,
        round(t.threshold, 6) AS threshold_mw, total_scored_rows, anomaly_count,
        round(anomaly_count / total_scored_rows::DOUBLE * 100, 6) AS anomaly_rate_percent, spike_count, drop_count,
        moderate_count, high_count, critical_count, least(anomaly_count, 10) AS top_count,
        strftime(b.ts, '%Y-%m-%dT%H:%M:%S') AS top_datetime, round(b.severity_score, 6) AS top_score,
        false AS threshold_fit_on_final_test
      FROM counts c JOIN thresholds t USING (series_id) LEFT JOIN best b USING (series_id)""",
    "top_anomalies": PANEL_SCORED + """
      SELECT series_id, CAST(place AS INTEGER) AS place, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS datetime,
        round(y, 6) AS actual_mw, round(prediction, 6) AS prediction_mw, round(residual, 6) AS residual_mw,
        round(absolute_residual, 6) AS absolute_residual_mw, round(severity_score, 6) AS severity_score, direction, severity
      FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY severity_score DESC, ts) AS place FROM anomalies)
      WHERE place <= 10""",
    "severity_counts": PANEL_SCORED
    + "SELECT series_id, severity, count(*) AS count FROM anomalies GROUP BY series_id, severity",
    "severity_mix_dense": PANEL_SCORED + """
      SELECT CAST(l.level AS INTEGER) AS level, l.severity, count(a.series_id) AS count
      FROM (VALUES (1, 'moderate'), (2, 'high'), (3, 'critical')) l(level, severity)
      LEFT JOIN anomalies a USING (severity) GROUP BY l.level, l.severity""",
    "direction_mix": PANEL_SCORED + """,
      counts AS (SELECT series_id, count(*) FILTER (direction = 'spike') AS spike_count,
                        count(*) FILTER (direction = 'drop') AS drop_count FROM anomalies GROUP BY series_id)
      SELECT series_id, spike_count, drop_count,
        round(coalesce(100.0::DOUBLE * spike_count / nullif(spike_count + drop_count, 0), 0), 6) AS spike_pct,
        round(coalesce(100.0::DOUBLE * drop_count / nullif(spike_count + drop_count, 0), 0), 6) AS drop_pct,
        CASE WHEN spike_count > drop_count THEN 'SPIKES' WHEN drop_count > spike_count THEN 'DROPS'
             ELSE 'BALANCED' END AS dominant_direction FROM counts""",
    "artifact_alignment": PANEL_FRAME + """
      SELECT count(*) FILTER (split <> 'train') AS prediction_rows, count(*) FILTER (split = 'test') AS reserved_rows,
        count(*) FILTER (split = 'validation') AS only_in_predictions, 0::BIGINT AS only_in_reserved,
        0::BIGINT AS uneven_keys, 0::BIGINT AS repeated_keys FROM frame""",
    "integrity_status": PANEL_SCORED + """
      SELECT series_id, CASE WHEN bad THEN 'REVIEW REQUIRED' ELSE 'FROZEN · LEAKAGE SAFE' END AS status,
        'TRAIN_ONLY' AS training_scope, 'UNSEEN VALIDATION RESIDUALS' AS threshold_source,
        'PREDICTION ONLY' AS validation_role,
        CASE WHEN bad THEN 'REVIEW REQUIRED' ELSE 'TEST UNTOUCHED' END AS threshold_fitting,
        'SCORING ONLY' AS final_test_usage
      FROM (SELECT series_id, bool_or(severity = 'critical') AS bad FROM scored GROUP BY series_id)""",
    "date_window_filter": """
      SELECT event_id, ts, event_type, value FROM events
      WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'""",
    "membership_filter": PANEL_SCORED
    + f"SELECT {SCORED} FROM scored WHERE severity IN ('high', 'critical') AND direction = 'spike'",
    "empty_selection": PANEL_SCORED + "SELECT count(*) AS rows FROM scored WHERE severity = 'none of them'",
    "equality_filter": PANEL_SCORED
    + "SELECT series_id, count(*) AS rows FROM scored WHERE direction = 'drop' GROUP BY series_id",
    "residual_histogram": PANEL_SCORED + ", " + histogram("scored"),
    "histogram_by_series": PANEL_FRAME + f", {RESIDUALS}, " + histogram("residuals", "series_id"),
    "calibration_bounds": PANEL_FRAME + """
      SELECT series_id, least(min(y), min(lag_168)) AS min_value, greatest(max(y), max(lag_168)) AS max_value
      FROM frame GROUP BY series_id""",
    "rolling_mae_7d": PANEL_FRAME + f""", {RESIDUALS}
      SELECT series_id, ts, round(absolute_error, 6) AS absolute_error,
        round(CASE WHEN count(absolute_error) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) >= 24
          THEN avg(absolute_error) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END, 6) AS rolling_mae_7d
      FROM residuals""",
    "halo_rolling_mae": f"""WITH {LONG_SERIES}
      SELECT series_id, ts, round(abs(y), 9) AS absolute_error,
        round(CASE WHEN count(*) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) >= 24
          THEN avg(abs(y)) {OVER} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END, 9) AS rolling_mae_7d
      FROM series""",
    "worst_errors": PANEL_FRAME + f""", {RESIDUALS}
      SELECT series_id, ts, y, prediction, residual, absolute_error FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY absolute_error DESC, ts) AS place
        FROM residuals WHERE split = 'validation') WHERE place <= 10""",
    "top_events_report": PANEL_SCORED + """
      SELECT series_id AS series, ts AS "timestamp", round_even(y, 1) AS actual, round_even(prediction, 1) AS forecast,
        round_even(severity_score, 2) AS score, direction, severity FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY severity_score DESC, ts) AS place FROM anomalies)
      WHERE place <= 20""",
    "label_text": """
      SELECT upper(replace(event_type, '_', ' ')) AS label,
        strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS hour_text, count(*) AS rows
      FROM events GROUP BY 1, 2""",
    "monitoring_metrics": PANEL_SCORED + f""",
      bounds AS (SELECT CAST(max(ts) AS DATE) AS last, greatest(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) - 29) AS first
                 FROM scored),
      shown AS (SELECT s.* FROM scored s, bounds WHERE ts >= first AND ts < last + INTERVAL 1 DAY),
      measured AS (
        SELECT {METRICS}, count(*) FILTER (is_anomaly AND direction = 'spike') AS spike_count,
          count(*) FILTER (is_anomaly AND direction = 'drop') AS drop_count,
          count(*) FILTER (severity = 'critical') AS critical_count,
          1 - sum(residual * residual) / (count(*) * var_pop(y)) AS r2, avg(residual) AS bias,
          quantile_cont(absolute_residual, 0.5) AS median_absolute_error,
          quantile_cont(absolute_residual, 0.95) AS p95_absolute_error FROM shown)
      SELECT round(MAE, 6) AS mae, round(RMSE, 6) AS rmse, round(MAPE, 6) AS mape, spike_count, drop_count,
        critical_count, round(r2, 6) AS r2, round(bias, 6) AS bias,
        round(median_absolute_error, 6) AS median_absolute_error, round(p95_absolute_error, 6) AS p95_absolute_error
      FROM measured""",
    "expanding_folds": PANEL_FOLDS + """
      SELECT series_id, ts, rn, CAST(f.fold AS INTEGER) AS fold,
        CASE WHEN p.fold = f.fold THEN 'validation' ELSE 'train' END AS role
      FROM placed p JOIN (VALUES (1), (2), (3), (4)) f(fold) ON coalesce(p.fold, 1) <= f.fold""",
    "fold_bounds": PANEL_FOLDS + """
      SELECT series_id, CAST(f.fold AS INTEGER) AS fold, first_row + (f.fold - 1) * fold_size AS train_end,
        CASE WHEN f.fold = 4 THEN n_development ELSE first_row + f.fold * fold_size END AS validation_end
      FROM (SELECT DISTINCT series_id, first_row, fold_size, n_development FROM shape),
           (VALUES (1), (2), (3), (4)) f(fold)""",
    "fold_counts": PANEL_FOLDS + """
      SELECT series_id, CAST(f.fold AS INTEGER) AS fold,
        count(*) FILTER (p.fold IS NULL OR p.fold < f.fold) AS train_rows,
        count(*) FILTER (p.fold = f.fold) AS validation_rows
      FROM placed p, (VALUES (1), (2), (3), (4)) f(fold) GROUP BY series_id, f.fold""",
    "backtest_naive": with_frame(PANEL, FOLDS, FOLD_METRICS) + f"""
      SELECT series_id, CAST(fold AS INTEGER) AS fold, model, {ROUNDED_METRICS}, train_seconds, predict_seconds
      FROM fold_metrics""",
    "backtest_summary": with_frame(PANEL, FOLDS, FOLD_METRICS) + """
      SELECT series_id, model, round(MAE_mean, 6) AS MAE_mean, round(MAE_std, 6) AS MAE_std,
        round(RMSE_mean, 6) AS RMSE_mean, round(RMSE_std, 6) AS RMSE_std, round(MAPE_mean, 6) AS MAPE_mean,
        round(MAPE_std, 6) AS MAPE_std, round(MAPE_variability, 6) AS MAPE_variability, train_seconds_mean,
        predict_seconds_mean,
        CAST(row_number() OVER (PARTITION BY series_id ORDER BY MAPE_mean NULLS LAST, model) AS INTEGER) AS rank
      FROM summary""",
    "backtest_record": PANEL_FOLDS + f""",
      overall AS (SELECT fold, model, {METRICS} FROM {MODELS.format("placed")} WHERE fold IS NOT NULL GROUP BY fold, model),
      means AS (SELECT model, avg(MAPE) AS mean_mape, stddev_samp(MAPE) AS std_mape FROM overall GROUP BY model)
      SELECT 4::INTEGER AS n_folds, 0.5::DOUBLE AS min_train_fraction,
        (SELECT count(*) FROM frame WHERE split <> 'test') AS development_rows,
        (SELECT count(*) FROM frame WHERE split = 'test') AS reserved_test_rows,
        arg_min(model, mean_mape) AS winner_by_mean_mape,
        round(max(mean_mape) FILTER (model = 'Seasonal Naive'), 6) AS mean_0,
        round(max(mean_mape) FILTER (model = 'lag_24'), 6) AS mean_1,
        round(max(mean_mape) FILTER (model = 'rolling_mean_24'), 6) AS mean_2,
        round(max(std_mape) FILTER (model = 'Seasonal Naive'), 6) AS std_0,
        round(max(std_mape) FILTER (model = 'lag_24'), 6) AS std_1,
        round(max(std_mape) FILTER (model = 'rolling_mean_24'), 6) AS std_2,
        false AS test_set_evaluated FROM means""",
    "comparison_table": with_frame(PANEL, COMPARED) + f"""
      SELECT series_id, model, {ROUNDED_METRICS},
        round({IMPROVEMENT.format("series_id")}, 6) AS mape_improvement_percent,
        CAST(row_number() OVER (PARTITION BY series_id ORDER BY MAPE NULLS LAST, model) AS INTEGER) AS rank
      FROM measured""",
    "comparison_record": PANEL_FRAME + f""",
      overall AS (SELECT model, {METRICS} FROM {MODELS.format("frame")} WHERE split = 'validation' GROUP BY model),
      base AS (SELECT MAE, MAPE FROM overall WHERE model = 'Seasonal Naive')
      SELECT round((SELECT MAE FROM base), 6) AS naive_mae,
        round((SELECT RMSE FROM overall WHERE model = 'lag_24'), 6) AS lag_24_rmse,
        arg_min(model, MAPE) AS validation_winner, round(min(MAPE), 6) AS winner_mape,
        round(((SELECT MAPE FROM base) - min(MAPE)) / (SELECT MAPE FROM base) * 100, 6)
          AS winner_relative_mape_improvement_percent, false AS test_set_evaluated FROM overall""",
    "near_ties": with_frame(PANEL, FOLDS, FOLD_METRICS) + """
      SELECT series_id, model, round(MAPE_mean, 6) AS MAPE_mean FROM (
        SELECT *, min(MAPE_mean) OVER (PARTITION BY series_id) AS best FROM summary) WHERE MAPE_mean - best <= 0.05::DOUBLE""",
    "select_model": with_frame(PANEL, FOLDS, FOLD_METRICS, COMPARED) + """,
      eligible AS (
        SELECT series_id, model, m.MAPE AS validation_mape, s.MAPE_mean, s.MAPE_std,
          CASE model WHEN 'lag_24' THEN 1 ELSE 2 END AS place,
          s.MAPE_mean - min(s.MAPE_mean) OVER (PARTITION BY series_id) <= 0.05::DOUBLE AS near
        FROM measured m JOIN summary s USING (series_id, model) WHERE model <> 'Seasonal Naive'),
      chosen AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id
          ORDER BY validation_mape, MAPE_mean, MAPE_std, place) AS pick FROM eligible WHERE near) WHERE pick = 1),
      other AS (
        SELECT * FROM (SELECT e.*, row_number() OVER (PARTITION BY e.series_id ORDER BY e.place) AS pick
          FROM eligible e JOIN chosen c ON e.series_id = c.series_id AND e.model <> c.model) WHERE pick = 1)
      SELECT c.series_id, c.model AS selected_model, o.model AS runner_up,
        round(c.validation_mape, 6) AS selected_validation_mape, round(c.MAPE_mean, 6) AS selected_backtest_mape,
        round(o.validation_mape, 6) AS runner_up_validation_mape, round(o.MAPE_std, 6) AS runner_up_backtest_std,
        false AS test_set_evaluated
      FROM chosen c JOIN other o USING (series_id)""",
}
