"""Which documents hold passages of benchmark items: a prefix-filtered containment join.

An item is a set of windows of ``window`` consecutive words. A window's shingles (three
words, or the whole window if it is shorter) are ordered by how often the corpus has them.
A window that a document contains has its rarest shingle there, so that one shingle is a
sufficient prefix: only it is indexed, and a window whose rarest shingle the corpus lacks is
done. A document's shingles that match a prefix become candidates with their surroundings.
The shingle's offset in the window must leave room for the window between the ends of the
text (length and position), and then the words themselves are compared.

Texts are read twice: once to count the shingles of items, once for candidates. Each task
gets a bitmap of bounded size to leave out what no item has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bitmap import Bitmap, collect_bitmap
from loadcast.llm.words import Words, alphanumeric, split_words
from loadcast.session import stage

SHINGLE_WORDS = 3
BROADCAST_ROWS = 100_000


def _joined(part: Words, folded: bytes, first: int, last: int) -> str:
    """Words ``first`` to ``last`` of a slice, lower-cased, joined by one space."""
    spans = zip(part.starts[first:last], part.ends[first:last], strict=True)
    return b" ".join(folded[a:b] for a, b in spans).decode()


def _item_windows(window: int):
    names = ["item_id", "passage", "size", "offset", "shingle"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, passage, size, offset, shingle = [], [], [], [], []
            ids = batch.column(0).to_pylist()
            for part in split_words(batch.column(1), alphanumeric()):
                folded = part.data.tobytes().lower()
                for i, n in enumerate(part.lengths):
                    length = min(int(n), window)
                    k = min(length, SHINGLE_WORDS)
                    for at in range(part.bounds[i], part.bounds[i + 1] - length + 1) if n else ():
                        places = np.arange(at, at + length - k + 1)
                        item += [ids[part.first + i]] * len(places)
                        passage += [_joined(part, folded, at, at + length)] * len(places)
                        size += [length] * len(places)
                        offset += range(len(places))
                        shingle.append(part.sequence_hashes(places, k).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item, pa.string()),
                    pa.array(passage, pa.string()),
                    pa.array(size, pa.int32()),
                    pa.array(offset, pa.int32()),
                    pa.array(np.concatenate(shingle) if shingle else np.zeros(0, np.int64)),
                ],
                names=names,
            )

    return run


def _shingle_counts(bitmap, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Bitmap = bitmap.value
        found: list[np.ndarray] = []
        held = 0

        def told() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], names=["shingle", "n"])

        for batch in batches:
            for part in split_words(batch.column(1), alphanumeric()):
                for k in sizes:
                    _, hashes = part.sequences(k)
                    found.append(hashes[known.has(hashes)].view(np.int64))
                    held += len(found[-1])
            if held > 1 << 20:
                yield told()
                found, held = [], 0
        if held:
            yield told()

    return run


_CANDIDATE = "key long, id long, n_words long, shingle long, place long, first long, around string"


def _candidates(bitmap, sizes: list[int], window: int):
    """A row for each document, and one for each place of a shingle that a window is under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Bitmap = bitmap.value
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for part in split_words(batch.column(1), alphanumeric()):
                own = keys[part.first : part.first + part.count]
                yield _rows(own, batch.column(2).slice(part.first, part.count), part.lengths, None, None, None, None)
                folded = None
                for k in sizes:
                    at, hashes = part.sequences(k)
                    hit = known.has(hashes)
                    if not hit.any():
                        continue
                    folded = folded or part.data.tobytes().lower()
                    at, hashes, text = at[hit], hashes[hit], part.text[at[hit]]
                    low = np.maximum(at - (window - k), part.bounds[text])
                    high = np.minimum(at + window, part.bounds[text + 1])
                    around = [_joined(part, folded, a, b) for a, b in zip(low, high, strict=True)]
                    base = part.bounds[text]
                    yield _rows(own[text], None, part.lengths[text], hashes.view(np.int64), at - base, low - base, around)

    return run


def _rows(keys, ids, n_words, shingle, place, first, around) -> pa.RecordBatch:
    n = len(keys)
    column = lambda v, kind: pa.nulls(n, kind) if v is None else pa.array(v, kind)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int64()),
            column(ids, pa.int64()),
            pa.array(n_words, pa.int64()),
            column(shingle, pa.int64()),
            column(place, pa.int64()),
            column(first, pa.int64()),
            column(around, pa.string()),
        ],
        names=["key", "id", "n_words", "shingle", "place", "first", "around"],
    )


def _bounded(df: DataFrame) -> DataFrame:
    """A staged table as a broadcast side if its counted rows are few, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 10,
) -> DataFrame:
    """Per document: words, words inside any window of an item, and the items found.

    Returns ``id_column, n_words, n_hit, n_items, items_sha256, contaminated``; the digest is
    of the item ids as strings, sorted and joined by commas. Words are ASCII letters (A-Z read
    as a-z), digits and anything beyond ASCII. An item of fewer words than ``window``, but not
    none, is one window. Null, empty and wordless texts have no words and no hit, null items
    no window. An item without an id marks words but is not counted. Each row is judged by its own
    text, also one without an id or with a repeated one. Texts of any length are read whole.
    Empty tables give no hits, or no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    texts = texts.select(F.xxhash64("id", F.lit("/"), "text").alias("key"), "text", "id")
    sources = items.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text_column).alias("text"))
    windows = stage(
        sources.mapInArrow(
            _item_windows(window), "item_id string, passage string, size int, offset int, shingle long"
        ),
        "windows",
    )
    shingles = windows.select("shingle").distinct()
    lengths = windows.select(F.least("size", F.lit(SHINGLE_WORDS)).alias("k")).distinct()
    sizes = sorted(r.k for r in lengths.collect())  # at most SHINGLE_WORDS rows
    every = spark.sparkContext.broadcast(collect_bitmap(shingles, "shingle", shingles.count()))
    counted = texts.mapInArrow(_shingle_counts(every, sizes), "shingle long, n long")
    counts = counted.groupBy("shingle").agg(F.sum("n").alias("n"))
    # The rarest shingle of each window; one that the corpus lacks rules the window out.
    ranked = windows.select("passage", "size", "offset", "shingle").distinct().join(counts, "shingle", "left")
    rarest = ranked.groupBy("passage", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("shingle"), F.col("offset"))).alias("key")
    )
    prefixes = stage(
        rarest.where("key.n > 0").select("passage", "size", F.col("key.shingle"), F.col("key.offset")), "prefixes"
    )
    keys = prefixes.select("shingle").distinct()
    kept = spark.sparkContext.broadcast(collect_bitmap(keys, "shingle", keys.count()))
    read = stage(texts.mapInArrow(_candidates(kept, sizes, window), _CANDIDATE), "candidates")
    begin = F.col("place") - F.col("offset")
    hits = (
        read.where("shingle is not null")
        .join(_bounded(prefixes), "shingle")
        .where((begin >= 0) & (begin + F.col("size") <= F.col("n_words")))
        .where(
            F.concat_ws(
                " ", F.slice(F.split("around", " "), (begin - F.col("first") + 1).cast("int"), F.col("size"))
            )
            == F.col("passage")
        )
        .select("key", begin.alias("begin"), (begin + F.col("size")).alias("end"), "passage")
    )
    owners = stage(windows.select("passage", "item_id").distinct(), "owners")
    found = (
        hits.join(_bounded(owners), "passage")
        .groupBy("key")
        .agg(
            F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
    )
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate(
        "spans",
        nothing,
        lambda s, x: F.struct(
            (s.n + F.greatest(F.lit(0).cast("long"), x.end - F.greatest(s.upto, x.begin))).alias("n"),
            F.greatest(s.upto, x.end).alias("upto"),
        ),
        lambda s: s.n,
    )
    n_hit = F.coalesce(covered, F.lit(0).cast("long"))
    item_ids = F.coalesce("items", F.array().cast("array<string>"))
    return (
        read.where("shingle is null")
        .select("key", "id", "n_words")
        .join(found, "key", "left")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            n_hit.alias("n_hit"),
            F.size(item_ids).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", item_ids), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
