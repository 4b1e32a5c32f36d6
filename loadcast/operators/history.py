"""Features that look back along the series: lags, rolling statistics, the naive forecast.

All look-backs count rows, not hours: a gap in the hours is not filled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.calendar import with_calendar
from ..schema import DEFAULT_COLUMNS, SeriesColumns, require_columns, require_positive
from .layout import Layout, measure, spread
from .ordering import BLOCK, OWN, cut_into_blocks, series_window, with_halo

# The lags, the forecast horizon and the two rolling lengths, in rows.
LAGS = (24, 48, 168)
HORIZON = 24
DAY, WEEK = 24, 168
FEATURE_LOOKBACK = HORIZON + WEEK - 1


def along_series(
    df: DataFrame,
    build: Callable[[WindowSpec], list[dict[str, Column]]],
    lookback: int,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    layout: Layout | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Evaluate backward-looking expressions over each series in time order.

    ``build`` receives the ordered window and returns the new columns, in steps
    where a later step may use an earlier one; none may reach back more than
    ``lookback`` rows in all. Columns named ``_…`` are dropped at the end. Short
    series are windowed whole. With a long series present, the blocks of the time
    axis are windowed instead, each preceded by a copy of the rows its look-back
    needs. All steps share one shuffle and one sort.
    """
    layout = layout or measure(df, cols.series)
    if not layout.blocked:
        return _apply(spread(df, [cols.series], layout), build(series_window(cols)))
    rows = layout.block_rows
    halo = spread(with_halo(cut_into_blocks(df, rows, cols, layout.tasks), lookback, rows), [cols.series, BLOCK], layout)
    built = _apply(halo, build(series_window(cols, BLOCK))).where(OWN).drop(OWN)
    return built if keep_blocks else built.drop(BLOCK)


def _apply(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*[name for step in steps for name in step if name.startswith("_")])


def history_columns(target: str) -> Callable[[WindowSpec], list[dict[str, Column]]]:
    """Lags, the mean and deviation of the day before the horizon, and the mean of the week.

    Statistics need every value of their window. Spark evaluates a sliding frame
    afresh for each row, so the week is put together from seven day sums instead
    of being a frame of 168 rows.
    """

    def build(w: WindowSpec) -> list[dict[str, Column]]:
        y = F.col(target)
        day = w.rowsBetween(-HORIZON - DAY + 1, -HORIZON)
        complete, day_sum = F.col("_day_count") == DAY, F.col("_day_sum")
        sums = [day_sum, *[F.lag(day_sum, DAY * k).over(w) for k in range(1, WEEK // DAY)]]
        return [
            {
                **{f"lag_{k}": F.lag(y, k).over(w) for k in LAGS},
                "_day_count": F.count(y).over(day),
                "_sum_24": F.sum(y).over(day),
                "_std_24": F.stddev_samp(y).over(day),
            },
            {
                "_day_sum": F.when(complete, F.col("_sum_24")),
                "rolling_std_24": F.when(complete, F.col("_std_24")),
            },
            {
                "rolling_mean_24": day_sum / DAY,
                # Any missing part makes the whole NULL.
                "rolling_mean_168": sum(sums[1:], sums[0]) / WEEK,
            },
        ]

    return build


def forecast_features(
    df: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    layout: Layout | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Calendar and history features; a row sees nothing later than 24 rows before it."""
    require_columns(df, [cols.time, cols.target], keep_order=True)
    built = along_series(df, history_columns(cols.target), FEATURE_LOOKBACK, cols, layout, keep_blocks)
    return with_calendar(built, cols)


def seasonal_naive(
    df: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    lag_rows: int = WEEK,
    layout: Layout | None = None,
    name: str = "prediction",
) -> DataFrame:
    """The value ``lag_rows`` rows earlier, one week by default."""
    require_columns(df, [cols.target], "target column")
    require_positive("lag_hours", lag_rows)
    return along_series(df, lambda w: [{name: F.lag(cols.target, lag_rows).over(w)}], lag_rows, cols, layout)


def rolling_mae(
    predictions: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    window_rows: int = WEEK,
    min_rows: int = 24,
    layout: Layout | None = None,
    name: str = "rolling_mae_7d",
) -> DataFrame:
    """Mean absolute error of the last week, from the first day's worth of rows on.

    The window is put together from equal shorter ones, as in the features.
    """
    require_positive("window_rows", window_rows)
    error = F.col("absolute_error")
    length = min((d for d in range(1, window_rows + 1) if window_rows % d == 0), key=lambda d: d + window_rows // d)

    def build(w: WindowSpec) -> list[dict[str, Column]]:
        frame = w.rowsBetween(-(length - 1), Window.currentRow)

        def whole(part: str) -> Column:
            parts = [F.lag(part, length * k, 0).over(w) for k in range(1, window_rows // length)]
            return sum(parts, F.col(part))

        count = F.col("_count")
        return [
            {
                "_part_sum": F.coalesce(F.sum(error).over(frame), F.lit(0.0)),
                "_part_count": F.count(error).over(frame),
            },
            {"_sum": whole("_part_sum"), "_count": whole("_part_count")},
            {name: F.when(count >= min_rows, F.try_divide(F.col("_sum"), count))},
        ]

    return along_series(predictions, build, window_rows - 1, cols, layout)
