"""Vector codes: a codebook for each part of the vectors, nearest entries by Orchard's search.

For every entry of a codebook the other entries are listed by their distance from it. A
search starts at an entry and walks its list. An entry not yet marked is marked and compared;
a nearer one is jumped to, and the walk goes on in its list. An entry further from the
current one than twice the current distance cannot be nearer, nor can any behind it: there the
search ends. Distances are squared and whole, so "twice" is four times and ties are exact.

A round is one pass over the written integers: each task searches its rows and adds up the
parts of each entry; Spark adds the tasks' sums. The driver holds the codebooks only:
entries by dimension, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.vectors import dimension, matrix, packed
from loadcast.session import stage

SCALE, LIMIT, INTEGER = 4096, 2.0**26, "<i4"
PARTS, ENTRIES, ROUNDS = 8, 16, 6


class Orchard:
    """Nearest entries of one codebook, for many searches side by side."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, -1)
        # Each entry's own place comes first; it is not part of its list.
        self.lists = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry nearest to each row, the lower one of equally near, and its squared distance."""
        n, others = len(x), self.lists.shape[1]
        at, place = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        best = ((x - self.entries[0]) ** 2).sum(axis=1)
        marked = np.zeros((n, len(self.entries)), dtype=bool)
        marked[:, 0] = True
        going = np.arange(n) if others else np.zeros(0, dtype=np.int64)
        while len(going):
            current, step = at[going], place[going]
            inside = self.apart[current, step] <= 4 * best[going]
            going, current, step = going[inside], current[inside], step[inside]
            entry = self.lists[current, step]
            place[going] += 1
            new = ~marked[going, entry]
            tried, entry, current = going[new], entry[new], current[new]
            marked[tried, entry] = True
            distance = ((x[tried] - self.entries[entry]) ** 2).sum(axis=1)
            better = (distance < best[tried]) | ((distance == best[tried]) & (entry < current))
            moved = tried[better]
            at[moved], best[moved], place[moved] = entry[better], distance[better], 0
            going = going[place[going] < others]
        return at, best


def _search(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of every row; ``books`` is parts x entries x width."""
    parts = x.astype(np.int64).reshape(len(x), len(books), -1)
    found = [Orchard(book).nearest(parts[:, p]) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _padded(packed_rows: pa.Array, dim: int, width: int) -> np.ndarray:
    x = matrix(packed_rows, INTEGER, dim)
    return np.pad(x, ((0, 0), (0, width - dim))) if width > dim else x


def _entry_sums(books: np.ndarray, dim: int):
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, size), dtype=np.int64)
        for batch in batches:
            x = _padded(batch.column(0), dim, parts * size)
            chosen, _ = _search(x, books)
            for p, e in np.ndindex(parts, entries):
                own = chosen[:, p] == e
                count[p, e] += own.sum()
                total[p, e] += x[own, p * size : (p + 1) * size].sum(axis=0, dtype=np.int64)
        part, entry, place = np.unravel_index(np.arange(total.size), total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v.astype(np.int32)) for v in (part, entry, place)]
            + [pa.array(np.repeat(count.reshape(-1), size)), pa.array(total.reshape(-1))],
            names=["part", "entry", "place", "n", "total"],
        )

    return run


def _next_books(rows: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    """Every entry as the floored mean of its parts; an entry without parts stays."""
    sums = (
        rows.select("x")
        .mapInArrow(_entry_sums(books, dim), "part int, entry int, place int, n long, total long")
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    after = books.copy()
    for row in sums.where("n > 0").collect():
        after[row["part"], row["entry"], row["place"]] = row["total"] // row["n"]
    return after


def vector_codes(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``id_column``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row.

    Left out are rows whose vector is null, empty, of another length than most, or has an entry
    that is null, not finite or of 16384 or more. Entries count as ``floor(4096 * entry)``; a
    length that ``parts`` does not divide is filled up with zeros. The codebooks start from the
    rows with the smallest ids (ties by vector, rows without an id last), fewer than ``entries``
    if there are fewer. Repeated rows count each. Rows without a label are one label. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_column].dataType.simpleString()
    dim = dimension(rows, vector_column)
    # Under names of its own: the id and the label may be one column, or called like a result.
    named = rows.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    kept = stage(packed(named, ["id", "label"], "vector", SCALE, LIMIT, INTEGER, dim), "integers") if dim else None
    seeds = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect() if dim else []
    if not seeds:
        return spark.createDataFrame(
            [], f"`{id_column}` {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    width = -(-dim // parts) * parts
    start = _padded(pa.array([bytes(s["x"]) for s in seeds], pa.binary()), dim, width).astype(np.int64)
    books = start.reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _next_books(kept, books, dim)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, distance = _search(_padded(batch.column(2), dim, width), books)
            text = [c.tobytes().hex() for c in chosen.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(distance.sum(axis=1))],
                names=["id", "label", "code", "error"],
            )

    label = kept.schema["label"].dataType.simpleString()
    codes = stage(kept.mapInArrow(coded, f"id {kind}, label {label}, code string, error long"), "codes")
    # A label may hold any part of the rows: its sum is joined as one row, and Spark splits the rows.
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
