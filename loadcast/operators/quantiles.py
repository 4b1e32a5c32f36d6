"""Exact quantiles per group, with linear interpolation, for groups of any size."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import ensure_finite
from ..schema import require_between
from ..session import stage
from .layout import DEFAULT_ROWS_PER_TASK, ROWS_PER_TASK_CONF, join_by_series, measure, setting

VALUE = "_value"
# Items that a sketch keeps at its widest level. A rank that it gives is off by this share of the
# rows in 99 of 100 cases: 2.296 / k ** 0.9021, as the sketch's documentation has it.
SKETCH_SIZE = 4096
SKETCH_ERROR = 2.296 / SKETCH_SIZE**0.9021
# Ranks at which a sketch is read, the steps of them that make up its error, and the share of the
# rows that an interval then holds.
GRID = 2048
STEPS = math.ceil(SKETCH_ERROR * GRID)
SHARE = (2 * STEPS + 1) / GRID + 2 * SKETCH_ERROR


def group_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    quantiles: Mapping[str, float],
    hot: bool | None = None,
    name: str = "values",
    also: Sequence[Column] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """One row per group with the named exact quantiles of ``value``.

    The built-in ``percentile`` keeps one map of distinct values per group, so
    it is used while every group fits one task. With ``hot`` groups the ranks are
    found by narrowing instead; ``hot=None`` measures the groups first. ``also``
    holds further aggregates to compute in the same pass.
    """
    for q in quantiles.values():
        require_between("quantile", q)
    by = list(by)
    limit = rows_per_task or setting(df.sparkSession, ROWS_PER_TASK_CONF, DEFAULT_ROWS_PER_TASK)
    if hot is None:
        hot = measure(df.select(*by, F.lit(0).alias("_all")), [*by, "_all"], limit).blocked
    checked = ensure_finite(value.cast("double"), name)
    if not hot:
        # One percentile call for all fractions, so values are buffered once.
        fractions = [float(q) for q in quantiles.values()]
        found = df.groupBy(*by).agg(*also, F.percentile(checked, fractions).alias("_found"))
        return found.withColumns({n: F.col("_found")[i] for i, n in enumerate(quantiles)}).drop("_found")
    found = _by_narrowing(df.select(*by, checked.alias(VALUE)), by, dict(quantiles), limit)
    return attach(df.groupBy(*by).agg(*also), found, by) if also else found


def attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put two results of the same grouping side by side."""
    if by:
        return left.join(right, list(by), "left")
    return left.select("*", *[right.select(name).scalar().alias(name) for name in right.columns])


def _by_narrowing(rows: DataFrame, by: list[str], quantiles: dict[str, float], limit: int) -> DataFrame:
    """Find the values at the wanted ranks without gathering any group.

    A quantile needs the values at one or two ranks. One aggregation counts each group and
    builds its mergeable sketch, whose rank error is bounded; that gives an interval of values
    for every rank, with about two errors' share of the group in it. Where that is small, one
    more pass counts the values of the interval and what lies below it, and reads the rank off.
    Where it is not, rounds come between: each counts exactly and sketches the interval in one
    aggregation. A rank that its interval missed goes on in the part that the counts name. The
    sketch only steers: its error costs time, never correctness.
    """
    constant = [] if by else ["_all"]
    if constant:
        rows = rows.withColumn("_all", F.lit(0))
    keys = by or constant
    wanted = []
    for index, q in enumerate(quantiles.values()):
        place = (F.col("_n") - 1) * F.lit(float(q))
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            wanted.append(
                F.struct(
                    F.lit(index).alias("_index"),
                    F.lit(side).alias("_side"),
                    rank.cast("bigint").alias("_rank"),
                    (place - F.floor(place)).alias("_fraction"),
                )
            )
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(VALUE).alias("_lo"),
        F.max(VALUE).alias("_hi"),
        F.kll_sketch_agg_double(VALUE, SKETCH_SIZE).alias("_sketch"),
    )
    each = totals.select("*", F.explode(F.array(*wanted)).alias("_want")).select(
        *keys, "_want.*", "_lo", "_hi", F.lit(0).cast("bigint").alias("_before"), F.col("_n").alias("_inside"),
        F.lit(None).cast("bigint").alias("_was"), "_sketch",
    )
    state = stage(_proposed(each), "quantile-ranks")
    found = None
    while True:
        open_ranks = state.where(_open(limit)).count()
        while open_ranks:
            state = stage(_narrow(rows, state, keys, limit, open_ranks), "quantile-ranks")
            open_ranks = state.where(_open(limit)).count()
        read = stage(_values_at_ranks(rows, state, keys, state.count()), "quantile-values")
        found = read if found is None else found.unionByName(read)
        missed = state.join(read.select(*keys, "_index", "_side"), [*keys, "_index", "_side"], "left_anti")
        ranks = missed.count()
        if not ranks:
            break
        state = stage(_settle(rows, missed, keys, ranks), "quantile-ranks")
    picked = [
        F.max(F.when((F.col("_index") == i) & (F.col("_side") == side), F.col(column))).alias(f"_{side}_{i}{suffix}")
        for i in range(len(quantiles))
        for side, column, suffix in (("low", VALUE, ""), ("high", VALUE, ""), ("low", "_fraction", "_fraction"))
    ]
    wide = found.groupBy(*keys).agg(*picked)
    values = []
    for i, label in enumerate(quantiles):
        low, high, fraction = F.col(f"_low_{i}"), F.col(f"_high_{i}"), F.col(f"_low_{i}_fraction")
        # Weighted as the built-in percentile does it, so that both ways agree to the last bit.
        between = (1 - fraction) * low + fraction * high
        values.append(F.when(low == high, low).otherwise(between).alias(label))
    return wide.select(*by, *values)


def _proposed(state: DataFrame) -> DataFrame:
    """``_from`` and ``_to`` by the sketch of each rank's interval, which is then dropped.

    The sketch is read at a fixed grid of ranks; the rank's place in it, a sketch's error to
    either side, names the two values.
    """
    grid = F.expr(f"array({', '.join(f'{i / GRID}D' for i in range(GRID + 1))})")
    place = F.floor((F.col("_rank") - F.col("_before")) / F.col("_inside") * GRID).cast("int")

    def value(step: int) -> Column:
        return F.get("_grid", F.greatest(F.least(place + step, F.lit(GRID)), F.lit(0)))

    usable = F.col("_sketch").isNotNull() & (F.col("_lo") < F.col("_hi"))
    read = F.when(usable, F.kll_sketch_get_quantile_double("_sketch", grid))
    return (
        state.withColumn("_grid", read)
        .withColumns(
            {
                "_from": F.when(usable, F.greatest("_lo", value(-STEPS))).otherwise(F.col("_lo")),
                "_to": F.when(usable, F.least("_hi", value(STEPS + 1))).otherwise(F.col("_hi")),
            }
        )
        .drop("_sketch", "_grid")
    )


def _open(limit: int) -> Column:
    """Ranks whose proposed interval is too large to read. No progress means that few distinct
    values are left, and those collapse in the last step.
    """
    shrinking = F.col("_was").isNull() | (F.col("_inside") < F.col("_was"))
    return (F.col("_lo") < F.col("_hi")) & (SHARE * F.col("_inside") > limit) & shrinking


def _narrow(rows: DataFrame, state: DataFrame, keys: list[str], limit: int, ranks: int) -> DataFrame:
    """One round: shrink the interval of every rank whose interval is still too wide."""
    wide = _open(limit)
    return state.where(~wide).unionByName(_settle(rows, state.where(wide), keys, ranks))


def _settle(rows: DataFrame, state: DataFrame, keys: list[str], ranks: int) -> DataFrame:
    """Count what is below, in and above each proposed interval, and go on where the rank is.

    The same aggregation sketches what is in the interval, for the next proposal.
    """
    bounds = [*keys, "_lo", "_hi", "_from", "_to"]
    x = F.col(VALUE)
    within = x.between(F.col("_from"), F.col("_to"))
    split = (
        join_by_series(rows, state.select(*bounds).distinct(), keys, ranks)
        .where(x.between(F.col("_lo"), F.col("_hi")))
        .groupBy(*bounds)
        .agg(
            F.count_if(x < F.col("_from")).alias("_below"),
            F.count_if(within).alias("_within"),
            F.count_if(x > F.col("_to")).alias("_above"),
            F.max(F.when(x < F.col("_from"), x)).alias("_below_hi"),
            F.min(F.when(x > F.col("_to"), x)).alias("_above_lo"),
            F.kll_sketch_agg_double(F.when(within, x), SKETCH_SIZE).alias("_sketched"),
        )
    )
    offset = F.col("_rank") - F.col("_before")
    is_below = offset < F.col("_below")
    is_within = offset < F.col("_below") + F.col("_within")

    def choose(below: Column, within: Column, above: Column) -> Column:
        return F.when(is_below, below).when(is_within, within).otherwise(above)

    none = F.lit(None)
    chosen = state.join(split, bounds).select(
        *keys,
        "_index",
        "_side",
        "_rank",
        "_fraction",
        choose(F.col("_lo"), F.col("_from"), F.col("_above_lo")).alias("_lo"),
        choose(F.col("_below_hi"), F.col("_to"), F.col("_hi")).alias("_hi"),
        (
            F.col("_before")
            + choose(F.lit(0).cast("bigint"), F.col("_below"), F.col("_below") + F.col("_within"))
        ).alias("_before"),
        choose(F.col("_below"), F.col("_within"), F.col("_above")).alias("_inside"),
        F.col("_inside").alias("_was"),
        choose(none, F.col("_sketched"), none).alias("_sketch"),
    )
    return _proposed(chosen)


def _values_at_ranks(rows: DataFrame, state: DataFrame, keys: list[str], ranks: int) -> DataFrame:
    """Count the values of each proposed interval, and all below it as one, and read the ranks off.

    Ranks that are not in their interval have no row.
    """
    interval = [*keys, "_lo", "_hi", "_from", "_to"]
    x = F.col(VALUE)
    distinct = (
        join_by_series(rows, state.select(*interval).distinct(), keys, ranks)
        .where(x.between(F.col("_lo"), F.col("_to")))
        .groupBy(*interval, F.when(x >= F.col("_from"), x).alias(VALUE))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    through = (
        Window.partitionBy(*interval).orderBy(F.asc_nulls_first(VALUE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = distinct.withColumn("_through", F.sum("_copies").over(through)).where(F.col(VALUE).isNotNull())
    offset = F.col("_rank") - F.col("_before")
    return counted.join(state, interval).where(
        (offset < F.col("_through")) & (offset >= F.col("_through") - F.col("_copies"))
    )
