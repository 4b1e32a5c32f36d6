"""Does a saved prediction table cover exactly the reserved rows?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLUMNS, SeriesColumns, require_columns


def alignment(
    predictions: DataFrame, reserved: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, positions: bool = False
) -> DataFrame:
    """One row of counts comparing both tables by (series, time).

    Both sides are counted together, in one aggregation over their keys: nothing is
    joined, null keys match, and repeated keys neither multiply nor gather. With ``positions`` both tables must carry ``rn``, and a
    key at another position counts as unmatched.
    """
    require_columns(predictions, [cols.time, cols.target, "prediction"], "required columns (Final predictions)")
    keys = [*cols.key, "rn"] if positions else cols.key

    tagged = predictions.select(*keys, F.lit(1).alias("_saved"), F.lit(0).alias("_reserved")).unionByName(
        reserved.select(*keys, F.lit(0).alias("_saved"), F.lit(1).alias("_reserved"))
    )
    both = tagged.groupBy(*keys).agg(F.sum("_saved").alias("_saved"), F.sum("_reserved").alias("_reserved"))
    saved, expected = F.col("_saved"), F.col("_reserved")
    total = F.coalesce(F.sum(saved), F.lit(0)), F.coalesce(F.sum(expected), F.lit(0))
    return both.agg(
        total[0].alias("prediction_rows"),
        total[1].alias("reserved_rows"),
        F.count_if(expected == 0).alias("only_in_predictions"),
        F.count_if(saved == 0).alias("only_in_reserved"),
        F.count_if((saved > 0) & (expected > 0) & (saved != expected)).alias("uneven_keys"),
        F.count_if(saved > 1).alias("repeated_keys"),
    )


def validate_predictions(
    predictions: DataFrame, reserved: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, positions: bool = False
) -> None:
    """Raise unless the two tables hold the same keys: columns, then row count, then timestamps."""
    missing = sorted({cols.time, cols.target, "prediction"} - set(predictions.columns))
    if missing:
        raise ValueError(f"Final predictions artifact is missing required columns: {missing}")
    found = alignment(predictions, reserved, cols, positions).first()
    if found["prediction_rows"] != found["reserved_rows"]:
        raise ValueError("Final predictions row count does not match reserved test split.")
    if found["only_in_predictions"] or found["only_in_reserved"] or found["uneven_keys"]:
        raise ValueError("Final predictions timestamps do not match reserved test split.")
