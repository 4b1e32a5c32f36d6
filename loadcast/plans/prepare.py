"""From a demand table to complete, numbered and split feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import forecast_features
from ..operators.layout import Layout, measure
from ..operators.split import (
    TRAIN_RATIO,
    VALIDATION_RATIO,
    chronological_split,
    complete_cases,
    development_rows,
)
from ..schema import DEFAULT_COLUMNS, SeriesColumns
from ..session import stage


def prepare(
    series: DataFrame,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    layout: Layout | None = None,
    train_ratio: float = TRAIN_RATIO,
    validation_ratio: float = VALIDATION_RATIO,
    staged: bool = False,
) -> DataFrame:
    """Features, complete cases, positions and split, in that order.

    With short series this is one shuffle by series. With a long one the time
    axis is cut into blocks and both passes are staged in the shared folder.
    ``staged=True`` writes the result, one folder per part of the split, for runs
    that read it many times: a reader of one part opens that folder only, and with
    blocks the offsets are applied once.
    """
    layout = layout or measure(series, cols.series)
    features = forecast_features(series, cols, layout, keep_blocks=True)
    tagged = chronological_split(complete_cases(features, cols), cols, train_ratio, validation_ratio, layout)
    frame = tagged.withColumn("n_development", development_rows(F.col("n_rows"), train_ratio, validation_ratio))
    return stage(frame, "prepared", ["split"]) if staged else frame
