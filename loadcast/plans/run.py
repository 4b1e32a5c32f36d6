"""The whole workflow over stored artifacts, one step at a time.

Each step reads what earlier steps wrote, so steps can be separate Spark
applications. The series is prepared once per application.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import Layout, measure
from ..operators.metrics import backtest_summary
from ..operators.models import gradient_boosting, random_forest
from ..schema import BACKTEST_SCHEMA, COMPARISON_SCHEMA, DEFAULT_COLUMNS, GRADIENT_BOOSTING, RANDOM_FOREST, SeriesColumns
from ..sources import (
    load_model,
    load_predictions,
    load_record,
    load_series,
    require_paths,
    save_model,
    save_record,
    write_table,
)
from .backtest import backtest
from .comparison import compare_models
from .detection import calibrate_and_detect
from .diagnostics import analyze
from .final import final_evaluation
from .prepare import prepare
from .selection import select_model
from .training import train_baseline

STEPS = ["train", "compare", "backtest", "select", "final", "detect", "analyze"]


@dataclass
class Run:
    spark: SparkSession
    source: str
    output: str
    cols: SeriesColumns = DEFAULT_COLUMNS
    format: str = "csv"
    forest: Mapping[str, object] = field(default_factory=dict)
    boosting: Mapping[str, object] = field(default_factory=dict)
    parallelism: int = 1

    def path(self, *parts: str) -> str:
        return "/".join([self.output.rstrip("/"), *parts])

    @cached_property
    def series(self) -> DataFrame:
        return load_series(self.spark, self.source, self.cols, self.format)

    @cached_property
    def layout(self) -> Layout:
        # Before duplicates go: an upper bound, without the shuffle that removes them.
        raw = load_series(self.spark, self.source, self.cols, self.format, unique=True)
        return measure(raw, self.cols.series)

    @cached_property
    def frame(self) -> DataFrame:
        return prepare(self.series, self.cols, self.layout, staged=True)

    def train(self) -> None:
        found = train_baseline(self.frame, self.cols, random_forest(self.cols.target, **self.forest))
        save_model(found.model, self.path("models", "random_forest"))
        save_record(found.metrics, self.path("metrics", "training"))
        save_record(found.metadata, self.path("metrics", "training_metadata"))

    def compare(self) -> None:
        forest = load_model(self.spark, self.path("models", "random_forest"))
        challenger = gradient_boosting(self.cols.target, **self.boosting)
        found = compare_models(self.frame, forest, self.cols, challenger, self.path("models", "challenger"))
        write_table(found.table, self.path("metrics", "model_comparison_table"), order_by=["MAPE"])
        save_record(found.record, self.path("metrics", "model_comparison"))

    def backtest(self) -> None:
        makers = {
            RANDOM_FOREST: lambda: random_forest(self.cols.target, **self.forest),
            GRADIENT_BOOSTING: lambda: gradient_boosting(self.cols.target, **self.boosting),
        }
        found = backtest(self.frame, self.cols, makers, parallelism=self.parallelism)
        write_table(found.results, self.path("metrics", "backtest_results"), order_by=["fold", "model"])
        save_record(found.record, self.path("metrics", "backtest_summary"))

    def select(self) -> None:
        compared = self.path("metrics", "model_comparison_table")
        tested = self.path("metrics", "backtest_results")
        require_paths(self.spark, [compared, tested])
        untouched = "test_set_evaluated boolean"
        decision = select_model(
            self.spark.read.schema(COMPARISON_SCHEMA).parquet(compared),
            backtest_summary(self.spark.read.schema(BACKTEST_SCHEMA).parquet(tested)),
            comparison_record=load_record(self.spark, self.path("metrics", "model_comparison"), untouched),
            backtest_record=load_record(self.spark, self.path("metrics", "backtest_summary"), untouched),
        )
        save_record(decision, self.path("metrics", "model_selection"))

    def final(self) -> None:
        selection = load_record(
            self.spark, self.path("metrics", "model_selection"), "selected_model string, test_set_evaluated boolean"
        )
        forest = random_forest(self.cols.target, **self.forest)
        found = final_evaluation(self.frame, selection, self.cols, forest, claim=self.path("claims", "final_test"))
        write_table(
            found.predictions, self.path("predictions", "final_test"), "csv", order_by=[self.cols.series, self.cols.time]
        )
        save_model(found.model, self.path("models", "final"))
        save_record(found.record, self.path("metrics", "final_test_metrics"))

    def detect(self) -> None:
        saved = load_predictions(self.spark, self.path("predictions", "final_test"), self.cols)
        found = calibrate_and_detect(
            self.frame, saved, self.cols, random_forest(self.cols.target, **self.forest), layout=self.layout
        )
        order = [F.desc("severity_score"), F.asc(self.cols.time)]
        write_table(found.anomalies, self.path("anomalies", "final_test"), "csv", order_by=order)
        save_record(found.summary, self.path("metrics", "anomaly_summary"))

    def analyze(self) -> None:
        model = load_model(self.spark, self.path("models", "random_forest"))
        found = analyze(self.frame, model, self.cols)
        write_table(found.importance, self.path("metrics", "feature_importance"), "csv")
        write_table(found.worst, self.path("metrics", "worst_errors"), "csv")
        save_record(found.record, self.path("metrics", "validation_diagnostics"))

    def steps(self, names: list[str] = STEPS) -> None:
        for name in names:
            getattr(self, name)()
