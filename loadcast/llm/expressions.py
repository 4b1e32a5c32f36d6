"""Column expressions that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[ \\t-\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    r"""The words between the ASCII spaces ``\x20`` and ``\x09`` to ``\x0D``; none of null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def long(value: int) -> Column:
    return F.lit(value).cast("long")


def text_length(text: Column) -> Column:
    """Code points of a text, 0 of null."""
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")


def some_word(text: Column) -> Column:
    """Whether a text has a character other than ASCII spaces."""
    return F.rlike(text, F.lit("[^ \\t-\\r]"))


def running(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    value: Callable[[Column, Column], Column],
    kind: str,
    chunk: int = 64,
) -> Column:
    """``value(state, item)`` for each item in order, the state being that after the item.

    ``step(state, item)`` gives the next state, ``kind`` is the type of a value. The states at the
    start of each chunk come first, then the values chunk by chunk: one long array that grows
    would be copied for each item. Items that fit one chunk are taken at once.
    """
    none = F.array().cast(f"array<{kind}>")

    def own(k: Column) -> Column:
        return F.slice(items, k * chunk + 1, chunk)

    def one(state: Column, item: Column) -> Column:
        now = step(state.at, item)
        return F.struct(now.alias("at"), F.array_append(state.got, value(now, item)).alias("got"))

    def after(starts: Column, k: Column) -> Column:
        return F.array_append(starts, F.aggregate(own(k), F.element_at(starts, -1), step))

    def values(starts: Column) -> Column:
        return F.transform(
            parts,
            lambda k: F.aggregate(own(k), F.struct(F.get(starts, k).alias("at"), none.alias("got")), one, lambda s: s.got),
        )

    parts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / chunk).cast("int"))
    starts = F.aggregate(parts, F.array(zero), after)
    alone = F.aggregate(items, F.struct(zero.alias("at"), none.alias("got")), one, lambda s: s.got)
    return F.when(F.size(items) <= chunk, alone).otherwise(F.flatten(let(starts, values)))
