"""Error metrics and their summaries. Each is one partial-then-final aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import ensure_finite
from .layout import measure
from .quantiles import attach, group_quantiles


def _errors(actual: str, predicted: str) -> tuple[Column, Column]:
    y = ensure_finite(F.col(actual), "y_true")
    return y, y - ensure_finite(F.col(predicted), "y_pred")


def metric_columns(actual: str, predicted: str = "prediction") -> list[Column]:
    """MAE, RMSE and MAPE. Zero targets leave MAPE only; with no other target MAPE is NaN."""
    y, e = _errors(actual, predicted)
    relative = F.avg(F.abs(F.try_divide(e, y))) * 100
    return [
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        F.coalesce(relative, F.lit(float("nan"))).alias("MAPE"),
    ]


def error_metrics(
    df: DataFrame, by: Sequence[str] = (), actual: str = "y", predicted: str = "prediction"
) -> DataFrame:
    """Metrics per group, or over everything; an empty input to the latter is an error."""
    measured = df.groupBy(*by).agg(*metric_columns(actual, predicted), F.count(F.lit(1)).alias("_n"))
    if by:
        return measured.drop("_n")
    failure = F.raise_error(F.lit("y_true and y_pred must not be empty")).cast("double")
    guarded = F.when(F.col("_n") > 0, F.col("MAE")).otherwise(failure).alias("MAE")
    return measured.select(guarded, "RMSE", "MAPE")


def window_metrics(df: DataFrame, actual: str = "y", predicted: str = "prediction") -> DataFrame:
    """The same three numbers for a view; an empty view gives NaN."""
    names = ("MAE", "RMSE", "MAPE")
    measured = df.agg(*metric_columns(actual, predicted))
    return measured.select(*[F.coalesce(F.col(m), F.lit(float("nan"))).alias(m.lower()) for m in names])


def r_squared_column(actual: str, predicted: str = "prediction") -> Column:
    y, e = _errors(actual, predicted)
    n = F.count(F.lit(1))
    unexplained, total = F.sum(e * e), n * F.var_pop(y)
    constant = F.when(unexplained == 0, 1.0).otherwise(0.0)
    value = F.when(total == 0, constant).otherwise(1 - F.try_divide(unexplained, total))
    return F.when(n >= 2, value).otherwise(F.lit(float("nan")))


def forecast_quality(
    df: DataFrame, by: Sequence[str] = (), actual: str = "y", predicted: str = "prediction", hot: bool | None = None
) -> DataFrame:
    """R², bias, median and 95th-percentile absolute error; NaN where there are no rows."""
    absolute = F.abs(F.col(actual) - F.col(predicted))
    measured = group_quantiles(
        df,
        by,
        absolute,
        {"median_absolute_error": 0.5, "p95_absolute_error": 0.95},
        hot=hot,
        also=[
            r_squared_column(actual, predicted).alias("r2"),
            F.avg(F.col(actual) - F.col(predicted)).alias("bias"),
        ],
    )
    names = ["r2", "bias", "median_absolute_error", "p95_absolute_error"]
    return measured.select(*by, *[F.coalesce(F.col(n), F.lit(float("nan"))).alias(n) for n in names])


def error_quantiles(
    df: DataFrame, actual: str = "y", predicted: str = "prediction", hot: bool | None = None
) -> DataFrame:
    """Median and 95th-percentile absolute error of all rows; NaN where there are none."""
    wanted = {"median_absolute_error": 0.5, "p95_absolute_error": 0.95}
    found = group_quantiles(df, (), F.abs(F.col(actual) - F.col(predicted)), wanted, hot=hot)
    return found.select(*[F.coalesce(F.col(n), F.lit(float("nan"))).alias(n) for n in wanted])


def residual_diagnostics(
    df: DataFrame, by: Sequence[str] = (), actual: str = "y", predicted: str = "prediction", hot: bool | None = None
) -> DataFrame:
    """Distribution of residual, absolute error and absolute percentage error."""
    error = F.col(actual) - F.col(predicted)
    relative = F.try_divide(F.abs(error), F.abs(F.col(actual))) * 100
    if hot is None:
        hot = measure(df.select(*by, F.lit(0).alias("_all")), [*by, "_all"]).blocked
    absolute = {"median_absolute_error": 0.5, "p95_absolute_error": 0.95}
    # With small groups one pass gives everything, the quantiles of both values included.
    spread = [] if hot else [F.percentile(F.abs(error), list(absolute.values())).alias("_spread")]
    middle = group_quantiles(
        df,
        by,
        error,
        {"median_residual": 0.5},
        hot=hot,
        also=[
            *spread,
            F.count(F.lit(1)).alias("rows"),
            F.avg(error).alias("mean_residual"),
            F.stddev_samp(error).alias("residual_std"),
            F.avg(F.abs(error)).alias("mean_absolute_error"),
            F.max(F.abs(error)).alias("max_absolute_error"),
            F.avg(relative).alias("mean_absolute_percentage_error"),
        ],
    )
    if hot:
        both = attach(middle, group_quantiles(df, by, F.abs(error), absolute, hot=True), by)
    else:
        both = middle.withColumns({name: F.col("_spread")[i] for i, name in enumerate(absolute)})
    return both.select(
        *by,
        "rows",
        "mean_residual",
        "median_residual",
        "residual_std",
        "mean_absolute_error",
        "median_absolute_error",
        "p95_absolute_error",
        "max_absolute_error",
        "mean_absolute_percentage_error",
    )


def backtest_summary(results: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and spread over folds. ``_std`` is the sample form, ``_variability`` the population form."""
    aggregates = []
    for name in ("MAE", "RMSE", "MAPE"):
        aggregates += [F.avg(name).alias(f"{name}_mean"), F.stddev_samp(name).alias(f"{name}_std")]
    aggregates += [
        F.stddev_pop("MAPE").alias("MAPE_variability"),
        F.avg("train_seconds").alias("train_seconds_mean"),
        F.avg("predict_seconds").alias("predict_seconds_mean"),
    ]
    return results.groupBy(*by).agg(*aggregates)


def relative_improvement(
    metrics: DataFrame, baseline: str, by: Sequence[str] = (), name: str = "mape_improvement_percent"
) -> DataFrame:
    """Percentage by which each model's MAPE is below the baseline model's.

    A window over the few models of a group; a zero baseline gives NULL.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    base = F.max(F.when(F.col("model") == baseline, F.col("MAPE"))).over(group)
    gain = F.try_divide(F.col("_base") - F.col("MAPE"), F.col("_base")) * 100
    return metrics.withColumn("_base", base).withColumn(name, gain).drop("_base")


def time_bounds(df: DataFrame, time: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(time).cast("date").alias("min_date"), F.max(time).cast("date").alias("max_date")
    )


def scope_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
