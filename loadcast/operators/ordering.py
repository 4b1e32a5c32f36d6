"""Duplicate removal and chronological position, per series or along one long series."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULT_COLUMNS, SeriesColumns, without
from ..session import stage
from .layout import Layout, join_by_series, measure, spread

BLOCK = "_block"
ORDINAL = "_ordinal"
OWN = "_own"


def drop_duplicate_times(df: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS) -> DataFrame:
    """One row per (series, time): the smallest target, missing targets last.

    An aggregate rather than a ranking window, so copies of one key collapse
    before the shuffle however many there are.
    """
    extras = without(df.columns, [*cols.key, cols.target])
    if not extras:
        kept = df.groupBy(*cols.key).agg(F.min(cols.target).alias(cols.target))
    else:
        sortable = [
            f.name for f in df.schema.fields if f.name in extras and not isinstance(f.dataType, (T.MapType, T.VariantType))
        ]
        order = F.struct(F.col(cols.target).isNull(), F.col(cols.target), *sortable)
        first = F.min_by(F.struct(cols.target, *extras), order).alias("_first")
        kept = df.groupBy(*cols.key).agg(first).select(*cols.key, "_first.*")
    return kept.select(*df.columns)


def series_window(cols: SeriesColumns = DEFAULT_COLUMNS, *more: str):
    return Window.partitionBy(cols.series, *more).orderBy(cols.chronological)


def cut_into_blocks(
    df: DataFrame, rows: int, cols: SeriesColumns = DEFAULT_COLUMNS, ranges: int = 0
) -> DataFrame:
    """Number all rows in (series, time) order and cut that order into equal blocks.

    Range partitioning spreads one long series over many tasks. Each partition
    is written with its row positions, so the numbering is fixed once and does
    not depend on a cache surviving. Only the partition sizes reach the driver,
    one number per partition. ``ranges`` asks for more partitions than the
    session's default.
    """
    order = [F.col(cols.series), cols.chronological]
    more = [ranges] if ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = df.repartitionByRange(*more, *order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = stage(
        ranged.select("*", F.spark_partition_id().alias("_part"), position.alias("_position")), "ordered"
    )
    sizes = sorted((r["_part"], r["rows"]) for r in staged.groupBy("_part").agg(F.count("*").alias("rows")).collect())
    starts = accumulate((size for _, size in sizes), initial=0)
    table = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, starts)], "_part int, _start bigint"
    )
    return (
        staged.join(F.broadcast(table), "_part")
        .withColumn(ORDINAL, F.col("_start") + F.col("_position"))
        .withColumn(BLOCK, F.floor(F.col(ORDINAL) / F.lit(rows)).cast("bigint"))
        .select(*df.columns, ORDINAL, BLOCK)
    )


def with_halo(blocked: DataFrame, lookback: int, rows: int) -> DataFrame:
    """Copy the last ``lookback`` rows of each block into the next one.

    Every block but the last holds exactly ``rows`` rows, so one neighbour is
    always deep enough.
    """
    if lookback >= rows:
        raise ValueError(f"block size must be greater than the look-back of {lookback} rows")
    own = F.col(BLOCK)
    needed_later = F.col(ORDINAL) % rows >= rows - lookback
    copies = F.when(needed_later, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        blocked.withColumn("_copy", F.explode(copies))
        .withColumn(OWN, F.col("_copy") == F.col(BLOCK))
        .drop(BLOCK, ORDINAL)
        .withColumnRenamed("_copy", BLOCK)
    )


def number_rows(
    df: DataFrame, cols: SeriesColumns = DEFAULT_COLUMNS, layout: Layout | None = None
) -> DataFrame:
    """Add ``rn``, the dense 0-based position in the series, and ``n_rows``, its length.

    Takes either plain rows or rows already cut into blocks, some of which may have been dropped
    since. A long series is numbered by a scan of its blocks' counts: nothing but the cut itself
    is written, and the rows' own shuffle serves the counts and the numbering.
    """
    blocked = BLOCK in df.columns
    layout = layout or measure(df, cols.series)
    if not blocked and not layout.blocked:
        return df.withColumns(
            {
                "rn": (F.row_number().over(series_window(cols)) - 1).cast("bigint"),
                "n_rows": F.count(F.lit(1)).over(Window.partitionBy(cols.series)),
            }
        )
    if not blocked:
        # The cut has numbered the rows already, through all series.
        cut = cut_into_blocks(df, layout.block_rows, cols, layout.tasks).drop(BLOCK)
        starts = cut.groupBy(cols.series).agg(F.min(ORDINAL).alias("_before"), F.count(F.lit(1)).alias("n_rows"))
        found = join_by_series(cut, starts, cols.series, layout.n_series or None)
        return found.withColumn("rn", F.col(ORDINAL) - F.col("_before")).drop(ORDINAL, "_before")
    in_block = (F.row_number().over(series_window(cols, BLOCK)) - 1).cast("bigint")
    sizes = df.groupBy(cols.series, BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
    # A window over block counts: a long series has one row per block here.
    blocks = Window.partitionBy(cols.series)
    earlier = blocks.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        cols.series,
        BLOCK,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(blocks).alias("n_rows"),
    )
    # A (series, block) group is bounded, so past the broadcast bound the join cannot skew.
    return (
        join_by_series(df.withColumn("_in_block", in_block), offsets, [cols.series, BLOCK], layout.block_bound)
        .withColumn("rn", F.col("_before") + F.col("_in_block"))
        .drop(BLOCK, "_in_block", "_before")
    )
