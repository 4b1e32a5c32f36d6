"""Personal data: known forms, and what stands in the same places as they do.

The known forms are the seeds. Each seed, and each other string that looks like an identifier
(a word with a digit or an @, or a run of digit groups as numbers are written), is an instance with two lexical patterns: the two words before it, and
the word before with the word after. Spark scores the graph of patterns and instances in rounds.
A pattern's confidence for a kind is the share of its occurrences that are of that kind by now;
an unknown string that could be of that kind speaks against it by half only. An instance's is the chance that not all of its confident patterns are wrong. Patterns with
enough support at high confidence then find the identifiers that no form describes. Rounds go on
until the accepted patterns stay as they are.

Texts are read once. The graph holds only identifier-like strings and is joined and aggregated
by Spark; repeated edges are counted before they are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.expressions import let
from loadcast.llm.spans import in_order, written
from loadcast.session import stage

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIDENCE = 0.8
MIN_SUPPORT = 3
# What an unknown string that could be of a kind counts against a pattern of that kind.
DOUBT = 0.5

_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole or not at all, as its leftmost match would: no retries inside it.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Digit groups joined by one space or by ( ) . and -, taken whole: no retries inside it.
_RUN = re.compile(r"\(?[0-9]++(?:(?:\)[ .-]?\(?|[ .-]\(?|\()[0-9]++)++")
_LAST_GROUP = re.compile(r"[ ().-]+[0-9]+$")
_IP_LIKE = re.compile(r"[0-9]+(?:[.:,_-][0-9]+){3}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = ".,;:!?()[]{}<>\"'"
_SPACES = " \t\n\v\f\r"
_REACH = 80
MIN_DIGITS, MAX_DIGITS = 7, 19


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _AFTER_AT.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IP.search(text, at):
        at = m.end()
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


_DIGIT = re.compile("[0-9]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the known forms, leftmost and non-overlapping for each kind."""
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *s) for s in _ips(text)]
        out += [("card", *s) for s in _cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in _phones(text)]
    return out


def _digits(value: str) -> int:
    return sum("0" <= c <= "9" for c in value)


def _runs(text: str, busy: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Numbers of several words between the spans already taken: as many digits as a phone or a card has."""
    at = 0
    for first, last in [*busy, (len(text), len(text))]:
        for m in _RUN.finditer(text, at, max(at, first)):
            a, b = m.span()
            if b < len(text) and not (text[b] in _TRIM or text[b] in _SPACES):
                cut = _LAST_GROUP.search(text, a, b)
                b = cut.start() if cut else a
            if a and not (text[a - 1] in _TRIM or text[a - 1] in _SPACES):
                space = text.find(" ", a, b)
                a = space + 1 if space >= 0 else b
            if " " in text[a:b] and MIN_DIGITS <= _digits(text[a:b]) <= MAX_DIGITS:
                yield a, b
        at = max(at, last)


def like_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like strings beside the spans already taken, without punctuation around them.

    A number written as several words is one string; its words are strings of their own only if
    they could be an identifier by themselves.
    """
    if "@" not in text and not _DIGIT.search(text):
        return []
    out, busy, k = [], sorted((a, b) for _, a, b in taken), 0
    runs, r = list(_runs(text, busy)), 0
    for m in _words_with(text):
        a, b = m
        value = text[a:b]
        a, b = a + len(value) - len(value.lstrip(_TRIM)), b - (len(value) - len(value.rstrip(_TRIM)))
        while k < len(busy) and busy[k][1] <= a:
            k += 1
        while r < len(runs) and runs[r][1] <= a:
            r += 1
        part = r < len(runs) and runs[r][0] < b
        if a < b and not (k < len(busy) and busy[k][0] < b):
            if not part or _digits(text[a:b]) >= MIN_DIGITS or "@" in text[a:b] or _IP_LIKE.fullmatch(text, a, b):
                out.append((a, b))
    return sorted(out + runs)


def _words_with(text: str) -> Iterator[tuple[int, int]]:
    for m in _WORD.finditer(text):
        if "@" in m[0] or _DIGIT.search(m[0]):
            yield m.span()


def patterns(text: str, start: int, end: int) -> tuple[str, str]:
    """The two words before a span, and the word before with the word after.

    Words are lower case without punctuation around them; contexts reach ``_REACH`` characters.
    """
    before = [w.strip(_TRIM).lower() for w in text[max(0, start - _REACH) : start].split()[-2:]]
    after = [w.strip(_TRIM).lower() for w in text[end : end + _REACH].split()[:1]]
    left = before[-1] if before else ""
    return "2 " + " ".join(before), f"1 {left} _ {after[0] if after else ''}"


_SPAN = "array<struct<kind:string,start:long,end:long,value:string,patterns:array<string>>>"
_SPAN_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("value", pa.string()),
            ("patterns", pa.list_(pa.string())),
        ]
    )
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, like = [], []
        for value in batch.column(2):
            text = value.as_py() or ""
            spans = base_spans(text)
            others = [(None, a, b) for a, b in like_spans(text, spans)]
            for found, out in ((spans, base), (others, like)):
                out.append(
                    [
                        {"kind": k, "start": a, "end": b, "value": text[a:b], "patterns": list(patterns(text, a, b))}
                        for k, a, b in found
                    ]
                )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, _SPAN_ARROW), pa.array(like, _SPAN_ARROW)],
            names=["key", "id", "base", "others"],
        )


def _could_be(kind: Column, value: Column) -> Column:
    """Whether a string has what an instance of a kind must have, however it is written."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == "email", F.contains(value, F.lit("@")))
        .when(kind == "ip", F.rlike(value, F.lit("^[0-9]+([.:,_-][0-9]+){3}$")))
        .when(kind == "card", digits.between(12, 19))
        .otherwise((kind == "phone") & digits.between(7, 15))
    )


def _state(accepted: DataFrame) -> tuple:
    """Equal for equal patterns with equal confidence, to a thousandth."""
    same = F.xxhash64("pattern", "kind", F.round("confidence", 3))
    return tuple(accepted.agg(F.count("*"), F.bit_xor(same)).first())


def score_graph(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``pattern, kind`` of the patterns that are confident when they no longer change, or after ``rounds``.

    ``edges`` has ``pattern, value, kind, n``; ``kind`` is null for instances that are not seeds.
    A round only adds to beliefs and confidence, so the patterns come to rest.
    """
    known = edges.where("kind is not null").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    total = stage(edges.groupBy("pattern").agg(F.sum("n").alias("total")), "pattern-totals")
    once = stage(edges.groupBy("pattern", "value").agg(F.sum("n").alias("n")), "pattern-values")
    kinds = F.filter(F.array(*(F.lit(k) for k in KINDS)), lambda k: _could_be(k, F.col("value")))
    plausible = edges.where("kind is null").select("pattern", F.explode(kinds).alias("kind"), "n")
    open_cases = stage(plausible.groupBy("pattern", "kind").agg(F.sum("n").alias("plausible")), "plausible")
    before, turn = None, 0
    while True:
        weight = F.col("n") * F.col("belief")
        scored = (
            once.join(known, "value")
            .groupBy("pattern", "kind")
            .agg(
                F.sum(weight).alias("good"),
                F.sum(F.when(F.col("belief") < 1, weight).otherwise(0.0)).alias("believed"),
                F.count("*").alias("support"),
            )
            .join(total, "pattern")
            .join(open_cases, ["pattern", "kind"], "left")
            .withColumn("unsure", F.greatest(F.coalesce("plausible", F.lit(0)) - F.col("believed"), F.lit(0.0)))
            .withColumn("confidence", F.col("good") / (F.col("total") - DOUBT * F.col("unsure") + 1.0))
        )
        confident = (F.col("confidence") >= MIN_CONFIDENCE) & (F.col("support") >= MIN_SUPPORT)
        accepted = stage(scored.where(confident).select("pattern", "kind", "confidence"), f"patterns-{turn}")
        turn += 1
        now = _state(accepted)
        if now == before or now[0] == 0 or turn == rounds:
            return accepted
        before = now
        new = (
            edges.where("kind is null")
            .select("pattern", "value")
            .join(accepted, "pattern")
            .where(_could_be(F.col("kind"), F.col("value")))
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("belief"))
        )
        seeds = edges.where("kind is not null").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
        known = stage(seeds.unionByName(new).groupBy("value", "kind").agg(F.max("belief").alias("belief")), "known")


def _outermost(spans: Column) -> Column:
    """Spans that no other of them holds; they only overlap as a number and its words do."""

    def step(got: Column, s: Column) -> Column:
        last = F.element_at(got, -1)
        held = (F.size(got) > 0) & (s.end <= last.end)
        return F.when(held, got).otherwise(F.array_append(got, F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))))

    ordered = F.array_sort(
        spans,
        lambda a, b: F.when(a.start != b.start, F.when(a.start < b.start, -1).otherwise(1))
        .when(a.end != b.end, F.when(a.end > b.end, -1).otherwise(1))
        .otherwise(0),
    )
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return F.aggregate(ordered, none, lambda got, s: F.when(F.size(got) == 0, F.array(s)).otherwise(step(got, s)))


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: counts of known forms, their digest, and all spans.

    Returns ``id_column, n_email, n_ip, n_card, n_phone, n_found, base_sha256, spans``; the spans
    that patterns add have the kinds ``found_email`` and so on. A string that patterns of several
    kinds find is the first such kind, one inside another that patterns find is left out. A null text is read as an empty one. Rows without an id and
    repeated rows are read like others; extra columns are not read. Empty tables give no rows.
    """
    texts = docs.select(F.xxhash64(id_column, text_column).alias("key"), F.col(id_column).cast("long").alias("id"), text_column)
    read = stage(texts.mapInArrow(_find, f"key long, id long, base {_SPAN}, others {_SPAN}"), "identifiers")
    every = read.select(F.explode(F.concat("base", "others")).alias("s"))
    edges = stage(
        every.select(F.explode("s.patterns").alias("pattern"), "s.value", "s.kind")
        .groupBy("pattern", "value", "kind")
        .agg(F.count("*").alias("n")),
        "edges",
    )
    accepted = score_graph(edges, rounds).select("pattern", F.col("kind").alias("by"))
    ranks = F.array(*(F.lit(k) for k in KINDS))
    others = read.select("key", F.explode("others").alias("s")).distinct()
    found = (
        others.select("key", "s.start", "s.end", "s.value", F.explode("s.patterns").alias("pattern"))
        .join(accepted, "pattern")
        .where(_could_be(F.col("by"), F.col("value")))
        .groupBy("key", "start", "end")
        .agg(F.min(F.array_position(ranks, F.col("by"))).alias("rank"))
        .select(
            "key",
            F.struct(
                F.concat(F.lit("found_"), F.element_at(ranks, F.col("rank").cast("int"))).alias("kind"), "start", "end"
            ).alias("s"),
        )
        .groupBy("key")
        .agg(_outermost(F.collect_list("s")).alias("added"))
    )
    plain = F.transform("base", lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    both = read.select("key", "id", plain.alias("base")).join(found, "key", "left")
    order = KINDS + tuple(f"found_{k}" for k in KINDS)

    def digest(x: Column) -> Column:
        def count(kind: str) -> Column:
            return F.size(F.filter(x.base, lambda s: s.kind == kind)).cast("long")

        return F.struct(
            *(count(k).alias(f"n_{k}") for k in KINDS),
            F.size(x.added).cast("long").alias("n_found"),
            F.sha2(written(in_order(x.base, order)), 256).alias("base_sha256"),
            written(in_order(F.concat(x.base, x.added), order)).alias("spans"),
        )

    packed = F.struct("base", F.coalesce("added", none).alias("added"))
    return both.select("id", let(packed, digest).alias("d")).select(F.col("id").alias(id_column), "d.*")
