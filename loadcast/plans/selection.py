"""Choose a model by the written rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import NEAR_TIE
from ..schema import CANDIDATE_MODELS, require_columns


def confirm_untouched(record: DataFrame, name: str) -> None:
    """Refuse a record that does not say ``test_set_evaluated = false``. Reads one row."""
    row = record.select("test_set_evaluated").first() if "test_set_evaluated" in record.columns else None
    if row is None or row[0] is not False:
        raise ValueError(f"{name} artifact does not confirm an untouched test set.")


def select_model(
    comparison: DataFrame,
    backtest: DataFrame,
    by: Sequence[str] = (),
    candidates: Sequence[str] = tuple(CANDIDATE_MODELS),
    tolerance: float = NEAR_TIE,
    comparison_record: DataFrame | None = None,
    backtest_record: DataFrame | None = None,
) -> DataFrame:
    """One decision per group.

    Candidates known to both tables compete. Those within ``tolerance`` of the
    best mean backtest MAPE are near ties; of these the lowest validation MAPE
    wins, then mean backtest MAPE, then its deviation. The runner-up is the first
    other candidate in the given order. Each table has one row per group and
    model, so the join is small beside the data it summarises.
    """
    if comparison_record is not None:
        confirm_untouched(comparison_record, "Comparison")
    if backtest_record is not None:
        confirm_untouched(backtest_record, "Backtest")
    by = list(by)
    require_columns(comparison, [*by, "model", "MAPE"])
    require_columns(backtest, [*by, "model", "MAPE_mean", "MAPE_std"])
    left = comparison.where(F.col("model").isin(list(candidates))).select(
        *by, "model", F.col("MAPE").alias("validation_mape")
    )
    right = backtest.select(
        *by, "model", F.col("MAPE_mean").alias("backtest_mean_mape"), F.col("MAPE_std").alias("backtest_mape_std")
    )
    eligible = left.join(right, [*by, "model"])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    place = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("model"))
    rated = eligible.withColumns(
        {
            "_place": place,
            "_near": F.col("backtest_mean_mape") - F.min("backtest_mean_mape").over(group) <= tolerance,
        }
    )
    numbers = ["validation_mape", "backtest_mean_mape", "backtest_mape_std"]
    ranked = F.struct(*numbers, "_place", "model")
    in_order = F.struct("_place", "model", *numbers)
    # At most one entry per candidate is gathered.
    decided = rated.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_eligible"),
        F.min(F.when(F.col("_near"), ranked)).alias("_selected"),
        F.array_sort(F.collect_list(in_order)).alias("_all"),
    )
    failure = F.raise_error(F.lit("Not enough candidate models for model selection.")).cast("string")
    selected = F.when(F.col("_eligible") >= 2, F.col("_selected.model")).otherwise(failure)
    others = F.filter("_all", lambda c: c["model"] != F.col("_selected.model"))

    def measures(source: Column) -> Column:
        return F.struct(*[source[n].alias(n) for n in numbers])

    return decided.withColumn("_other", F.get(others, F.lit(0))).select(
        *by,
        selected.alias("selected_model"),
        F.col("_other.model").alias("runner_up"),
        F.struct(
            F.lit("expanding_window_mean_mape").alias("primary_evidence"),
            F.lit(float(tolerance)).alias("near_tie_tolerance_percentage_points"),
            F.lit("holdout_validation_mape").alias("tie_breaker"),
            F.lit("backtest_mape_std").alias("secondary_tie_breaker"),
        ).alias("policy"),
        measures(F.col("_selected")).alias("selected_model_metrics"),
        measures(F.col("_other")).alias("runner_up_metrics"),
        F.concat(
            F.col("_selected.model"),
            F.lit(f": lowest validation MAPE among models within {tolerance:.3f} points of the best backtest mean."),
        ).alias("reason"),
        F.lit(False).alias("test_set_evaluated"),
    )
