"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` optionally a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from loadcast.session import build_session  # noqa: E402

ONCE_SECONDS = 10

HEADLINE = [
    "load_dedup",
    "panel_features",
    "forecast_features",
    "halo_features",
    "dropna_split",
    "metrics_by_model",
    "r2_bias_quantiles",
    "residual_diagnostics",
    "hot_group_quantiles",
    "fit_threshold",
    "panel_anomalies",
    "anomaly_summary",
    "long_series_anomalies",
    "rolling_mae_7d",
    "residual_histogram",
    "worst_errors",
    "artifact_alignment",
    "expanding_folds",
    "backtest_summary",
    "select_model",
    "monitoring_metrics",
    "rf_forecast",
    "gbt_forecast",
]


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            # Small local tables: keep one task per core instead of merging to 1 MB.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
            "spark.driver.extraJavaOptions": os.environ.get("BENCH_JAVA", "-XX:+UseParallelGC"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM's file readers and code generation outside the measured time.
    QUERIES["time_bounds"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        # The median of three; a query over ten seconds runs once.
        runs = [timed(spark, sf_dir, name)]
        while runs[0] <= ONCE_SECONDS and len(runs) < 3:
            runs.append(timed(spark, sf_dir, name))
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
