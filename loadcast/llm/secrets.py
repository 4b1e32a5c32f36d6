"""Secrets in texts: known forms, and strings whose characters are as mixed as random ones.

Beside the known forms, candidate strings (long runs of token characters) are walked by a
window of ``WINDOW`` characters. The counts of the window's characters are kept up to date: one
character enters, one leaves, and the entropy changes by the two terms concerned, so a step
costs the same for any window. A window is suspicious if its Shannon entropy, in bits per
character, reaches the threshold of the candidate's character class. Overlapping suspicious
windows are one span. Windows that touch a segment on the allow list, and spans that touch a
known form, are suppressed. All of it is column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.expressions import let, long
from loadcast.llm.spans import in_order, matches, of_kind, written

ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# A run is found whole, so asking for its length in the pattern sees the same spans as after it.
LONG_ACCESS = "AKIA[A-Z0-9]{16,}"
LONG_HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made of these characters only, and how mixed a window must be."""

    name: str
    pattern: str
    bits: float


# From narrow to wide: a candidate belongs to the first class that holds all of it.
CLASSES = (
    CharacterClass("digits", "^[0-9]+$", 2.7),
    CharacterClass("lower hex", "^[0-9a-f]+$", 3.0),
    CharacterClass("upper hex", "^[0-9A-F]+$", 3.0),
    CharacterClass("one case", "^([a-z]+|[A-Z][a-z]*|[A-Z]+)$", 3.7),
    CharacterClass("alphanumeric", "^[A-Za-z0-9]+$", 3.7),
    CharacterClass("base 64", "^[A-Za-z0-9+/_-]+$", 3.9),
)
# A segment, between two separators, is suppressed if one of these is in it.
ALLOWED = (
    "(?i)example|placeholder|sample|dummy",
    "(?i)abcdefghijklmnop|0123456789abcdef",
    "0123456789|1234567890",
)
ALLOWED_ID = "(?<![A-Za-z0-9])[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![A-Za-z0-9])"
# Of words joined by separators only those as long as a window are scanned, each by itself.
JOINED_WORDS = "^[A-Za-z]+([_/+-][A-Za-z]+)+$"
LONG_WORD = f"[A-Za-z]{{{WINDOW},}}"
# Names written as words with capitals: letters only, no word as long as a window.
CAMEL = "^[A-Z]?[a-z]{1,18}([A-Z][a-z]{1,18})+$"
SEGMENT = "[A-Za-z0-9]+|[+/_-]+"
# What is left of a candidate, without the separators at its ends.
PIECE = f"[A-Za-z0-9][A-Za-z0-9+/_-]{{{WINDOW - 2},}}[A-Za-z0-9]"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"


def _term(count: Column) -> Column:
    """``c log2 c``, 0 for none."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def suspicious_windows(value: Column, bits: Column, window: int = WINDOW) -> Column:
    """Start and end, in characters of ``value``, of its merged suspicious windows.

    ``value`` has characters of the token alphabet only. The entropy of a window of w characters
    is ``log2 w - (sum of c log2 c) / w`` over the counts c of its characters.
    """
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(_ALPHABET), c))
    start = F.struct(
        F.array_repeat(F.lit(0), len(_ALPHABET) + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.array().cast("array<struct<start:int,end:int>>").alias("got"),
    )
    whole = F.log2(F.lit(float(window)))

    def step(state: Column, x: Column) -> Column:
        enters = F.get(state.counts, x.enters)
        entered = F.transform(state.counts, lambda c, k: F.when(k == x.enters, c + 1).otherwise(c))
        up = state.total + _term(enters + 1) - _term(enters)

        def leave(counts: Column) -> Column:
            leaves = F.get(counts, x.leaves)
            left = F.when(x.leaves < 0, counts).otherwise(
                F.transform(counts, lambda c, k: F.when(k == x.leaves, c - 1).otherwise(c))
            )
            total = F.when(x.leaves < 0, up).otherwise(up - _term(leaves) + _term(leaves - 1))
            full = x.i >= window - 1
            return let(
                F.struct(left.alias("counts"), total.alias("total"), full.alias("full")),
                lambda now: F.struct(
                    now.counts.alias("counts"),
                    now.total.alias("total"),
                    F.when(now.full & (whole - now.total / window >= bits - 1e-9), _extend(state.got, x.i, window))
                    .otherwise(state.got)
                    .alias("got"),
                ),
            )

        return let(entered, leave)

    def walk(at: Column) -> Column:
        steps = F.transform(
            at,
            lambda p, i: F.struct(
                p.alias("enters"),
                F.when(i >= window, F.get(at, i - window)).otherwise(F.lit(-1)).alias("leaves"),
                i.alias("i"),
            ),
        )
        return F.aggregate(steps, start, step, lambda s: s.got)

    return let(places, walk)


def _extend(got: Column, i: Column, window: int) -> Column:
    """The list of spans with the window that ends at ``i``, merged with the last if they touch."""
    n = F.size(got)
    first, end = i - (window - 1), i + 1
    last = F.get(got, n - 1)
    joined = F.concat(F.slice(got, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(F.struct(last.start.alias("start"), end.alias("end"))))
    apart = F.concat(got, F.array(F.struct(first.alias("start"), end.alias("end"))))
    return F.when((n > 0) & (last.end >= first), joined).otherwise(apart)


def _moved(spans: Column, by: Column) -> Column:
    return F.transform(spans, lambda s: F.struct((by + s.start).alias("start"), (by + s.end).alias("end")))


def scanned_pieces(value: Column) -> Column:
    """What the allow list leaves of a candidate, as spans with their places in it."""

    def allowed(x: Column) -> Column:
        out = F.lit(False)
        for pattern in ALLOWED:
            out = out | x.rlike(pattern)
        return out

    def blank(segments: Column) -> Column:
        return F.array_join(
            F.transform(segments, lambda s: F.when(allowed(s), F.repeat(F.lit(" "), F.char_length(s))).otherwise(s)), ""
        )

    parts = F.regexp_extract_all(value, F.lit(SEGMENT), F.lit(0))
    left = F.when(allowed(value), blank(parts)).otherwise(value)
    left = F.regexp_replace(left, ALLOWED_ID, " " * 36)
    whole = F.array(F.struct(long(0).alias("start"), F.char_length(value).cast("long").alias("end"), value.alias("value")))

    def words_apart(p: Column) -> Column:
        words = F.transform(
            matches(p.value, LONG_WORD),
            lambda w: F.struct((p.start + w.start).alias("start"), (p.start + w.end).alias("end"), w.value.alias("value")),
        )
        return F.when(p.value.rlike(JOINED_WORDS), words).when(p.value.rlike(CAMEL), F.slice(F.array(p), 1, 0)).otherwise(F.array(p))

    def pieces(x: Column) -> Column:
        return F.when(x == value, whole).otherwise(matches(x, PIECE))

    return F.flatten(F.transform(let(left, pieces), words_apart))


def entropy_spans(text: Column, window: int = WINDOW) -> Column:
    """Spans of suspicious windows over the candidates of a text."""

    none = F.array().cast("array<struct<start:int,end:int>>")

    def of_piece(c: Column) -> Column:
        bits = F.lit(None).cast("double")
        for kind in reversed(CLASSES):
            bits = F.when(c.value.rlike(kind.pattern), F.lit(kind.bits)).otherwise(bits)
        found = F.when(bits <= F.log2(F.lit(float(window))), suspicious_windows(c.value, bits, window))
        return _moved(F.coalesce(found, none), c.start)

    def of_candidate(c: Column) -> Column:
        spans = F.transform(scanned_pieces(c.value), of_piece)
        return _moved(F.flatten(spans), c.start)

    return F.flatten(F.transform(matches(text, CANDIDATE), of_candidate))


def secret_spans(text: Column) -> tuple[Column, Column]:
    """The known forms as one array of spans, and those the entropy adds."""
    assign = F.filter(
        matches(text, ASSIGN), lambda s: F.char_length(F.regexp_extract(s.value, f"^{ASSIGN}$", 1)) >= 6
    )
    base = F.concat(
        of_kind(assign, "assign"),
        of_kind(matches(text, LONG_ACCESS), "access"),
        of_kind(matches(text, LONG_HEX), "hex"),
    )
    return base, of_kind(entropy_spans(text), "entropy")


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of known forms, their digest, and all spans.

    Returns ``id_column, n_assign, n_access, n_hex, n_entropy, base_sha256, spans``. A null text
    is read as an empty one and has no span. Rows without an id or with a repeated id are read
    like others; extra columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    base, added = secret_spans(text)
    found = docs.select(F.col(id_column).alias("id"), F.struct(base.alias("base"), added.alias("added")).alias("f"))

    def digest(f: Column) -> Column:
        own = F.filter(f.added, lambda a: ~F.exists(f.base, lambda b: (a.start < b.end) & (b.start < a.end)))

        def count(spans: Column, kind: str) -> Column:
            return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")

        return F.struct(
            *(count(f.base, k).alias(f"n_{k}") for k in KINDS[:3]),
            F.size(own).cast("long").alias("n_entropy"),
            F.sha2(written(in_order(f.base, KINDS)), 256).alias("base_sha256"),
            written(in_order(F.concat(f.base, own), KINDS)).alias("spans"),
        )

    return found.select("id", let(F.col("f"), digest).alias("d")).select(F.col("id").alias(id_column), "d.*")
