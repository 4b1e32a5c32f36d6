"""Mixing sources to target weights by Pfair scheduling.

A source is a task whose weight is its share of the mix; a block of its documents is a subtask.
With weight w, block j (from 1) is released at slot ``floor((j - 1) / w)`` and due at
``ceil(j / w)``. Each slot takes the released block that is due first. As the weights sum to
one, no deadline is missed, and after t slots every source has been given less than one block
more or less than ``t * w``.

The period is the sum of the weights, without their common divisor; the schedule repeats after
it, so it is worked out once, over weights only, and any block's slot follows by arithmetic.
With a ``period`` given, weights are first rounded to quotas of so many slots, and the bound
holds against the quotas. Documents are ranked in their source through many small ranges, so a
source with a third of all documents is never in one task. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.expressions import let, long
from loadcast.session import stage

PERIOD = 240
SLOTS_PER_SOURCE = 8
BLOCK_DOCS = 16
CHUNK_SLOTS = 256
BROADCAST_ROWS = 100_000


def source_key(source: Column) -> Column:
    """A text for each source, also for the missing one."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def quotas(sources: DataFrame, period: int = PERIOD) -> DataFrame:
    """``key, n, weight`` with ``place``, ``period`` and ``quota`` added; quotas sum to the period.

    Weights are positive integers. Each source gets a slot; the rest goes out in proportion to
    the weights, and what is left over by largest remainder, ties by key. With many sources the
    period grows to ``SLOTS_PER_SOURCE`` slots for each.
    """
    all_rows = Window.partitionBy(F.lit(0))  # one row per source
    count = F.count("*").over(all_rows)
    slots = F.greatest(F.lit(period), SLOTS_PER_SOURCE * count).cast("long")
    sized = sources.select(
        "*",
        F.row_number().over(all_rows.orderBy("key")).alias("place"),
        slots.alias("period"),
        (slots - count).alias("free"),
        F.sum("weight").over(all_rows).alias("total"),
    )
    part = F.col("free") * F.col("weight")
    whole = F.expr("(free * weight) div total")
    shared = sized.withColumn("whole", whole).withColumn("rest", part % F.col("total"))
    left = F.col("free") - F.sum("whole").over(all_rows)
    order = F.row_number().over(all_rows.orderBy(F.desc("rest"), "key"))
    return shared.select(
        *sources.columns,
        "place",
        "period",
        (1 + F.col("whole") + F.when(order <= left, 1).otherwise(0)).cast("long").alias("quota"),
    )


def earliest_deadline_first(quota: Column, period: Column) -> Column:
    """The place (from 0) of the source that each slot of a period is given to."""

    def slot(state: Column, t: Column) -> Column:
        def window(q: Column, i: Column) -> Column:
            done = F.get(state.done, i)
            released = _div(done * period, q)
            due = _div((done + 1) * period + q - 1, q)
            return F.when((done < q) & (released <= t), F.struct(due.alias("due"), i.alias("i")))

        first = F.array_min(F.transform(quota, window))
        return let(
            first.i,
            lambda i: F.struct(
                F.transform(state.done, lambda d, k: F.when(k == i, d + 1).otherwise(d)).alias("done"),
                F.array_append(state.given, i).alias("given"),
            ),
        )

    nothing = F.struct(
        F.transform(quota, lambda q: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("given")
    )
    slots = F.sequence(F.lit(0).cast("long"), period - 1)
    return F.aggregate(slots, nothing, slot, lambda s: s.given)


def _div(a: Column, b: Column) -> Column:
    """Whole part of ``a / b`` for numbers that are not negative."""
    return ((a - a % b) / b).cast("long")


def schedule(sized: DataFrame) -> DataFrame:
    """``key, turn, at``: the slot of each turn of a source in a period. A row for each slot."""
    listed = sized.agg(
        F.sort_array(F.collect_list(F.struct("place", "key", "quota"))).alias("all"), F.max("period").alias("period")
    ).where("period is not null")
    given = listed.select(
        "all", F.posexplode(earliest_deadline_first(F.transform("all", lambda s: s.quota), F.col("period"))).alias("at", "i")
    )
    turns = Window.partitionBy("key").orderBy("at")
    return given.select(F.get("all", F.col("i")).key.alias("key"), "at").select(
        "key", (F.row_number().over(turns) - 1).cast("long").alias("turn"), F.col("at").cast("long").alias("at")
    )


def _whole(a: Column, b: Column) -> Column:
    """Whole part of ``a / b`` for longs of any size."""
    return F.call_function("div", a, b)


def _common_divisor(numbers: Column) -> Column:
    """Greatest common divisor of an array of positive longs, by Euclid's steps (at most 92 for longs)."""

    def both(a: Column, b: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            return F.when(s.b == 0, s).otherwise(F.struct(s.b.alias("a"), (s.a % F.nullif(s.b, long(0))).alias("b")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(92)), F.struct(a.alias("a"), b.alias("b")), step, lambda s: s.a)

    return F.aggregate(numbers, long(0), lambda g, n: both(n, g))


def exact_shares(sources: DataFrame, block_docs: int) -> DataFrame:
    """``key, n, quota, period, horizon, member, members``: the weights as they are, in lowest terms.

    Block ``horizon`` slots are enough for every block and the one after the last of each source.
    Sources of one weight are numbered by key: they have the same releases and deadlines.
    """
    sized = sources.groupBy("weight").agg(F.count("*").alias("members"), F.max("n").alias("most"))
    whole = sized.agg(
        F.sum(F.col("weight") * F.col("members")).alias("total"),
        _common_divisor(F.collect_list("weight")).alias("common"),
        F.max(F.ceil((F.col("most") / block_docs + 2) / F.col("weight") * 1_000_000)).alias("rounds"),
    ).where("total is not null")
    period = _whole(F.col("total"), F.col("common"))
    alike = Window.partitionBy("weight").orderBy("key")
    return (
        sources.withColumn("member", (F.row_number().over(alike) - 1).cast("long"))
        .join(F.broadcast(sized.select("weight", "members")), "weight")
        .crossJoin(F.broadcast(whole))
        .select(
            "key",
            "n",
            _whole(F.col("weight"), F.col("common")).alias("quota"),
            period.alias("period"),
            F.least(period, F.ceil(F.col("total") / 1_000_000.0 * F.col("rounds")).cast("long") + 1).alias("horizon"),
            "member",
            "members",
        )
    )


def exact_schedule(sized: DataFrame) -> DataFrame:
    """``key, turn, at`` of the first ``horizon`` slots of a period, one row for each slot.

    Earliest deadline first over the distinct weights: the blocks of sources of one weight go
    out in turn. Slots are worked out in chunks, so no long array is copied for every slot.
    """
    classes = sized.groupBy("quota").agg(F.max("members").alias("members"), F.max("period").alias("period"), F.max("horizon").alias("horizon"))
    listed = classes.agg(
        F.sort_array(F.collect_list(F.struct("quota", "members"))).alias("all"),
        F.max("period").alias("period"),
        F.max("horizon").alias("horizon"),
    ).where("period is not null")
    every, period, horizon = F.col("all"), F.col("period"), F.col("horizon")
    chunk = long(CHUNK_SLOTS)

    def slot(state: Column, t: Column) -> Column:
        def window(c: Column, i: Column) -> Column:
            turn = _whole(F.get(state.done, i), c.members)
            released = _whole(turn * period, c.quota)
            due = _whole((turn + 1) * period + c.quota - 1, c.quota)
            return F.when((turn < c.quota) & (released <= t), F.struct(due.alias("due"), i.alias("i")))

        return let(
            F.array_min(F.transform(every, window)).i,
            lambda i: F.struct(
                F.transform(state.done, lambda d, k: F.when(k == i, d + 1).otherwise(d)).alias("done"),
                F.array_append(state.given, F.struct(i.alias("i"), F.get(state.done, i).alias("nth"))).alias("given"),
            ),
        )

    none = F.array().cast("array<struct<i:int,nth:bigint>>")

    def slots(state: Column, k: Column) -> Column:
        span = F.sequence(k * chunk, F.least((k + 1) * chunk, horizon) - 1)
        start = F.struct(state.done.alias("done"), none.alias("given"))
        return let(
            F.aggregate(span, start, slot),
            lambda got: F.struct(got.done.alias("done"), F.array_append(state.given, got.given).alias("given")),
        )

    nothing = F.struct(
        F.transform(every, lambda c: long(0)).alias("done"), F.array().cast("array<array<struct<i:int,nth:bigint>>>").alias("given")
    )
    chunks = F.sequence(long(0), _whole(horizon - 1, chunk))
    given = listed.select("all", F.posexplode(F.flatten(F.aggregate(chunks, nothing, slots, lambda s: s.given))).alias("at", "x"))
    of_class = F.get("all", F.col("x.i"))
    turns = given.select(
        of_class.quota.alias("quota"),
        _whole(F.col("x.nth"), of_class.members).alias("turn"),
        (F.col("x.nth") % of_class.members).alias("member"),
        F.col("at").cast("long").alias("at"),
    )
    return turns.join(sized.select("key", "quota", "member"), ["quota", "member"]).select("key", "turn", "at")


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: dict[str, int] | None = None,
    period: int | None = None,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per document: ``id_column, source_column, block, slot, in_block, on_target``.

    ``slot`` then ``in_block`` is the order of the mix. ``weights`` are positive integers per
    source, 1 for a source that is not named; without them a source weighs the rounded-up square
    root of its documents. They are scheduled exactly, or, with a ``period``, rounded to quotas of
    so many slots, with at least one for each source. Documents of a source follow each other by the digest of their id.
    A source that runs out leaves its slots empty; ``on_target`` says that no source has run out
    before this slot. Documents without a source are a source of their own, those without an id
    come first in their source. Rows with the same id and source follow each other in any order.
    Extra columns are not read. An empty table gives an empty result.
    """
    keyed = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        source_key(F.col(source_column)).alias("key"),
        F.coalesce(F.md5(F.col(id_column).cast("string").cast("binary")), F.lit("")).alias("digest"),
    ).withColumn("range", F.substring("digest", 1, 3))
    counts = keyed.groupBy("key", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    sources = counts.groupBy("key").agg(F.sum("n").alias("n"))
    if weights is None:
        weight = F.ceil(F.sqrt("n")).cast("long")
    else:
        weight = F.lit(1).cast("long")
        for name, value in weights.items():
            weight = F.when(F.col("key") == f"s{name}", F.lit(int(value))).otherwise(weight)
    weighed = sources.withColumn("weight", weight.cast("long"))
    if period is None:
        sized = stage(exact_shares(weighed, block_docs), "shares")
        turns = stage(exact_schedule(sized), "turns")
    else:
        sized = quotas(weighed, period)
        turns = schedule(sized)
    blocks = F.ceil(F.col("n") / block_docs).cast("long")
    due = (
        sized.select("key", "quota", "period", _div(blocks, F.col("quota")).alias("round"), (blocks % F.col("quota")).alias("turn"))
        .join(turns, ["key", "turn"])
        .agg(F.min(F.col("round") * F.col("period") + F.col("at")).alias("slot"))
    )
    plan = turns.join(sized.select("key", "quota", "period"), "key")
    in_range = Window.partitionBy("key", "range").orderBy("digest", "id")
    ranked = keyed.join(offsets, ["key", "range"]).select(
        "id", "source", "key", (F.col("offset") + F.row_number().over(in_range) - 1).alias("rank")
    )
    quota = _bounded(sized.select("key", "quota"))
    placed = ranked.join(quota, "key").select(
        "id",
        "source",
        "key",
        _div(F.col("rank"), F.lit(block_docs)).alias("block"),
        (F.col("rank") % block_docs).alias("in_block"),
        "quota",
    )
    placed = placed.select("*", (F.col("block") % F.col("quota")).alias("turn"))
    slot = _div(F.col("block"), F.col("quota")) * F.col("period") + F.col("at")
    return (
        placed.join(_bounded(plan).select("key", "turn", "at", "period"), ["key", "turn"])
        .withColumn("runs_out", due.scalar())
        .select(
            F.col("id").alias(id_column),
            F.col("source").alias(source_column),
            "block",
            slot.alias("slot"),
            "in_block",
            (slot < F.col("runs_out")).alias("on_target"),
        )
    )
