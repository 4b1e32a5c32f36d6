"""Top-k, model ranking, near ties and the seeded sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLUMNS, SeriesColumns

# Near-tie tolerance in percentage points; display sample.
NEAR_TIE = 0.05
SAMPLE_ROWS, SAMPLE_SEED = 5000, 42


def top_k(
    df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = (), rank: str | None = None
) -> DataFrame:
    """First ``k`` rows overall or per group.

    Overall this is one bounded heap per task. Per group, Spark limits each map
    task to ``k`` rows of a group before the shuffle, so a hot group stays small.
    """
    if not by:
        limited = df.orderBy(*order).limit(k)
        if rank is None:
            return limited
        # Ranks over at most k rows.
        return limited.withColumn(rank, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def worst_errors(
    predictions: DataFrame, k: int = 10, by: Sequence[str] = (), cols: SeriesColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Largest absolute errors; the earlier row wins a tie."""
    return top_k(predictions, k, [F.desc("absolute_error"), F.asc(cols.time)], by)


def most_severe(
    anomalies: DataFrame, k: int | None = None, by: Sequence[str] = (), cols: SeriesColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Anomalies by falling severity; all of them, or the first ``k``.

    A full sort samples its input before it sorts. Anomalies are few beside the
    rows they were picked from, so they are shuffled once first: the sample then
    reads them instead of scoring every row again.
    """
    order = [F.desc("severity_score"), F.asc(cols.time)]
    if k is None:
        return anomalies.repartition(*cols.key).orderBy(*order)
    return top_k(anomalies, k, order, by)


def rank_models(table: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``rank`` over the given columns, ascending, then the model name."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return table.withColumn("rank", F.row_number().over(group.orderBy(*[F.asc_nulls_last(c) for c in order], "model")))


def near_best(
    table: DataFrame, metric: str, by: Sequence[str] = (), tolerance: float = NEAR_TIE
) -> DataFrame:
    """Models whose metric is within ``tolerance`` of the best, inclusive."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    best = F.min(metric).over(group)
    return table.withColumn("_best", best).where(F.col(metric) - F.col("_best") <= tolerance).drop("_best")


def seeded_sample(
    df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED, cols: SeriesColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """At most ``n`` rows, the same ones however the table is partitioned, and in any engine that has MD5."""
    drawn = F.md5(F.concat_ws("|", cols.series, F.col(cols.time).cast("string"), F.lit(seed)).cast("binary"))
    return df.orderBy(drawn, *cols.key).limit(n)
