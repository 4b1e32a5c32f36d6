"""Whole analyses composed from the operators."""

from .backtest import backtest, backtest_record, fold_metrics
from .comparison import compare_models, comparison_record, comparison_table
from .detection import Detection, calibrate_and_detect, detect, detect_within
from .diagnostics import analyze
from .final import FinalEvaluation, final_evaluation
from .integrity import integrity_status
from .monitoring import daily_tables, monitoring_view
from .prepare import prepare
from .run import Run
from .selection import select_model
from .stored import StoredView, stored_view
from .training import TrainingRun, train_baseline

__all__ = [
    "Detection",
    "FinalEvaluation",
    "Run",
    "StoredView",
    "TrainingRun",
    "analyze",
    "backtest",
    "backtest_record",
    "calibrate_and_detect",
    "compare_models",
    "comparison_record",
    "comparison_table",
    "daily_tables",
    "detect",
    "detect_within",
    "final_evaluation",
    "fold_metrics",
    "integrity_status",
    "monitoring_view",
    "prepare",
    "select_model",
    "stored_view",
    "train_baseline",
]
