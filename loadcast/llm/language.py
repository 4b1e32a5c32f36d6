"""Language by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters, words set off by single
spaces) of all training texts of a language, most frequent first. A text gets such a list too.
Its distance to a profile is the sum, over its n-grams, of how far each is out of place there;
an n-gram that the profile lacks is as far out as the profile is long. The nearest profile wins.

Profiles are counted over every training text: a task counts its own n-grams, Spark adds them
up. Only the finished profiles, ``TOP`` n-grams for each language, reach the driver and the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.session import stage

TOP = 300
SLICE_CHARACTERS = 1 << 19
FLUSH_ROWS = 1 << 20
UNKNOWN = "und"
_SPACE, _BITS = 32, 21
_CODES = 0x110000


class _Letters:
    """Letters by code point, looked up once for each that occurs; all others are a space."""

    def __init__(self) -> None:
        self.known = np.zeros(_CODES, dtype=bool)
        self.symbol = np.full(_CODES, _SPACE, dtype=np.uint32)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        new = codes[~self.known[codes]]
        if len(new):
            for code in np.unique(new):
                self.known[code] = True
                if chr(code).isalpha():
                    self.symbol[code] = code
        return self.symbol[codes]


_LETTERS: list[_Letters] = []


def _letters() -> _Letters:
    if not _LETTERS:
        _LETTERS.append(_Letters())
    return _LETTERS[0]


def symbols(text: str | None) -> np.ndarray:
    """A text as lower-case letters, with one space before, between and after its words."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    found = _letters().symbols(codes)
    letter = found != _SPACE
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    words = found[keep]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    ends = [_SPACE] if words[-1] != _SPACE else []
    return np.concatenate([[_SPACE], words, ends]).astype(np.uint64)


def n_grams(s: np.ndarray) -> np.ndarray:
    """Codes of all runs of one to three symbols but single spaces; 21 bits for each symbol."""
    bits = np.uint64(_BITS)
    pairs = (s[:-1] << bits) | s[1:]
    return np.concatenate([s[s != _SPACE], pairs, (pairs[:-1] << bits) | s[2:]])


def ranked(s: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, ties by code."""
    codes, counts = np.unique(n_grams(s), return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:top]]


@dataclass
class Profiles:
    """The places of n-grams in each language's list, ``top`` where a list lacks one."""

    languages: list[str]
    codes: np.ndarray
    places: np.ndarray
    top: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], top: int) -> Profiles:
        """From rows of language, n-gram and place."""
        languages = sorted({r[0] for r in rows})
        codes = np.unique(np.array([r[1] for r in rows], dtype=np.int64).view(np.uint64))
        places = np.full((len(codes), len(languages)), top, dtype=np.int64)
        at = {lang: i for i, lang in enumerate(languages)}
        for lang, code, place in rows:
            places[np.searchsorted(codes, np.uint64(code)), at[lang]] = place
        return cls(languages, codes, places, top)

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language with the smallest distance (ties: first by name), and how near it is."""
        s = symbols(text)
        if not len(s) or not self.languages:
            return UNKNOWN, 0.0
        grams = ranked(s, self.top)
        at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        places = np.where((self.codes[at] == grams)[:, None], self.places[at], self.top)
        own = np.arange(len(grams))[:, None]
        distance = np.where(places == self.top, self.top, np.abs(places - own)).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.top * len(grams)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, added up within the task as far as memory is bounded."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        total = np.bincount(inverse.reshape(-1), weights=np.concatenate([n for _, n in parts]), minlength=len(codes))
        return codes, total.astype(np.int64)

    def told() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes, n = merge(parts)
            names = pa.array([lang] * len(codes), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        waiting: dict[str, list[np.ndarray]] = {}
        length: dict[str, int] = {}

        def count(lang: str, waiting=waiting, length=length) -> None:
            # Texts are counted together: the space between them is theirs anyway, and n-grams
            # over the seam are left out by cutting each text's own.
            codes, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            length[lang] = 0
            held.setdefault(lang, []).append((codes, n))

        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            s = symbols(text.as_py())
            if not len(s):
                continue
            name = lang.as_py()
            waiting.setdefault(name, []).append(n_grams(s))
            length[name] = length.get(name, 0) + len(s)
            if length[name] > SLICE_CHARACTERS:
                count(name)
        for name in list(waiting):
            count(name)
        held = {lang: [merge(parts)] for lang, parts in held.items()}
        size = sum(len(codes) for parts in held.values() for codes, _ in parts)
        if size > FLUSH_ROWS:
            yield from told()
            held, size = {}, 0
    yield from told()


def held_out(id_column: str) -> Column:
    """Whether the id, as text, has a crc32 of 2 modulo 4: never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_column: str, text_column: str, lang_column: str, top: int = TOP) -> Profiles:
    """Profiles of every language of the training rows."""
    rows = docs.where(F.col(id_column).isNotNull() & F.col(lang_column).isNotNull() & ~held_out(id_column))
    counted = rows.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")).mapInArrow(
        _count, "lang string, gram long, n long"
    )
    totals = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "n-grams")
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # ``top`` rows for each language, cut in each task before the shuffle; never a plan for each.
    taken = totals.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= top).collect()
    return Profiles.of([(r.lang, r.gram, r.place - 1) for r in taken], top)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles: Profiles = shared.value
        for batch in batches:
            found = [profiles.nearest(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["id", "held_out", "lang_pred", "score"],
            )

    return run


def language(
    docs: DataFrame,
    train: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    top: int = TOP,
) -> DataFrame:
    """One row per row of ``docs``: ``id_column, held_out, lang_pred, score``.

    Profiles come from the rows of ``train`` (``docs`` itself if not given) that have an id, a
    language and are not held out. ``score`` is one less the distance as a share of the largest
    possible. A text that is null or has no letter is ``und`` with score 0, and so is every text
    if there is nothing to learn from. Equal distances go to the first language by name, equal
    counts to the smaller n-gram. Rows without an id and repeated rows are predicted like others.
    Extra columns are not read.
    """
    spark = docs.sparkSession
    profiles = learn(docs if train is None else train, id_column, text_column, lang_column, top)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text")
    )
    found = rows.mapInArrow(
        _predict(spark.sparkContext.broadcast(profiles)), "id long, held_out boolean, lang_pred string, score double"
    )
    return found.withColumnRenamed("id", id_column)
