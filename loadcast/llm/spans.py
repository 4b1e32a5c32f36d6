"""Spans that patterns find in texts, as column expressions: no Python runs.

A span is a struct of ``start`` and ``end`` (code points, end exclusive) and ``value``. Places
follow from the lengths of what lies between the matches: splitting a text by a pattern and
listing the pattern's matches see the same leftmost, non-overlapping matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadcast.llm.expressions import let, long, running


def matches(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches of a pattern that never matches the empty text.

    The time grows with the text and its matches, not with their square.
    """

    def walk(parts: Column) -> Column:
        pairs = F.transform(
            parts.hits, lambda v, i: F.struct(F.char_length(F.get(parts.gaps, i)).alias("gap"), v.alias("value"))
        )
        return let(
            pairs,
            lambda items: running(
                items,
                long(0),
                lambda at, x: at + x.gap + F.char_length(x.value),
                lambda at, x: F.struct(
                    (at - F.char_length(x.value)).alias("start"), at.alias("end"), x.value.alias("value")
                ),
                "struct<start:long,end:long,value:string>",
            ),
        )

    cut = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    none = F.array().cast("array<struct<start:long,end:long,value:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), let(cut, walk)).otherwise(none)


def of_kind(spans: Column, kind: str) -> Column:
    """The same spans with their kind."""
    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"))
    )


def in_order(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then by the kind's place in ``kinds``, then by end."""
    ranks = F.array(*(F.lit(k) for k in kinds))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s.start.alias("start"), F.array_position(ranks, s.kind).alias("rank"), s.end.alias("end"), s.kind.alias("kind")
        ),
    )
    return F.sort_array(keyed)


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas; empty if there is none."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
