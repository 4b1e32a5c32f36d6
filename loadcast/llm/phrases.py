"""Removal of passages that recur anywhere in the corpus, by automata of confirmed phrases.

1. Each window of ``window`` words has an anchor: of its six-word phrases, the one with the
   smallest hash. Equal windows have equal anchors, and only one phrase in about fifteen is
   an anchor. A phrase that is an anchor at two places or more is recurring.
2. Windows with a recurring anchor are gathered by hash; those found at two places or more
   are confirmed, and each shard of documents is told a place of each that it holds.
3. A shard reads the confirmed windows and their anchor phrases from its own texts, compiles
   the phrases to an Aho-Corasick automaton and streams all its texts through it. Around each
   phrase found, windows that are confirmed are removed: every occurrence, wherever it is.

A shard's automaton holds no more text than the shard does. No list of a phrase's places is
ever gathered as text, so a passage that a third of all documents share costs eight bytes for
each place in the task that confirms it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bitmap import Bitmap, collect_bitmap
from loadcast.llm.packing import PACKED, Packer, bucket_count, bucket_of, unpack
from loadcast.llm.words import Words, mix, spaced, split_words
from loadcast.session import stage

PHRASE_WORDS = 6
SHARD_BYTES = 64 << 20
_ANCHOR = np.dtype([("hash", "<u8"), ("often", "u1")])
_WINDOW = np.dtype([("hash", "<u8"), ("key", "<i8"), ("place", "<i8")])
_PLACE = np.dtype([("key", "<i8"), ("place", "<i8")])
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each run of ``width`` values, in log2(width) steps."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def windows_and_anchors(part: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index of each window, the hash of its anchor, and the hash of every phrase.

    Phrases that cross the end of a text have the largest hash; they are in no window.
    """
    n = len(part.hashes)
    phrases = np.full(n, _NONE, dtype=np.uint64)
    at, hashes = part.sequences(PHRASE_WORDS)
    phrases[at] = hashes
    span = n - window + 1
    if span <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), phrases
    lowest = _slide(phrases[: n - PHRASE_WORDS + 1], window - PHRASE_WORDS + 1, np.minimum)
    starts = np.flatnonzero(part.text[:span] == part.text[window - 1 :])
    return starts, lowest[starts], phrases


def anchor_places(part: Words, window: int) -> np.ndarray:
    """Hashes of the phrases that are an anchor, once for each place they are at."""
    starts, anchors, phrases = windows_and_anchors(part, window)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    width = window - PHRASE_WORDS + 1
    lowest = np.zeros(len(phrases) + 2 * width, dtype=np.uint64)
    lowest[starts + width] = anchors
    # A phrase is an anchor if it equals the lowest hash of some window over it.
    highest = _slide(lowest, width, np.maximum)[1 : len(phrases) + 1]
    return phrases[(phrases == highest) & (phrases != _NONE)]


def _pack_anchors(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(_ANCHOR, buckets)
        for batch in batches:
            found = [anchor_places(part, window) for part in split_words(batch.column(1), spaced(False))]
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield from out.add(bucket_of(hashes, buckets), hashes, n > 1)
        yield from out.flush()

    return run


def _recurring_anchors(table: pa.Table) -> pa.Table:
    hashes, often = unpack(table["packed"], _ANCHOR)
    values, group, n = np.unique(hashes, return_inverse=True, return_counts=True)
    many = np.zeros(len(values), dtype=bool)
    np.logical_or.at(many, group.reshape(-1), often.astype(bool))
    return pa.table({"anchor": pa.array(values[many | (n > 1)].view(np.int64))})


def _pack_windows(bitmap, window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Bitmap = bitmap.value
        out = Packer(_WINDOW, buckets)
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for part in split_words(batch.column(1), spaced(False)):
                starts, anchors, _ = windows_and_anchors(part, window)
                starts = starts[known.has(anchors)]
                hashes = part.sequence_hashes(starts, window)
                text = part.text[starts]
                place = starts - part.bounds[text]
                yield from out.add(bucket_of(hashes, buckets), hashes, keys[part.first + text], place)
        yield from out.flush()

    return run


def _confirmed(shards: int):
    """Of the windows at two places or more, one place for each shard that holds it."""

    def run(table: pa.Table) -> pa.Table:
        hashes, keys, places = unpack(table["packed"], _WINDOW)
        order = np.lexsort((places, keys, hashes))
        hashes, keys, places = hashes[order], keys[order], places[order]
        same = np.zeros(len(hashes) + 1, dtype=bool)
        same[1:-1] = hashes[1:] == hashes[:-1]
        keep = same[1:] | same[:-1]
        hashes, keys, places = hashes[keep], keys[keep], places[keep]
        shard = bucket_of(mix(keys.astype(np.uint64)), shards)
        order = np.lexsort((places, keys, hashes, shard))
        hashes, keys, places, shard = hashes[order], keys[order], places[order], shard[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (shard[1:] != shard[:-1])
        order = np.flatnonzero(new)[np.lexsort((places[new], keys[new]))]
        out = Packer(_PLACE, shards)
        rows = [*out.add(shard[order], keys[order], places[order]), *out.flush()]
        return pa.Table.from_batches(rows, schema=table.schema)

    return run


def _automaton(phrases: set[bytes]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase in phrases:
        automaton.add_word(f" {phrase.decode('latin-1')} ", len(phrase) + 2)
    automaton.make_automaton()
    return automaton


def covered_words(
    texts: pa.Array, told_text: np.ndarray, told_place: np.ndarray, window: int
) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """For each text: its index, its words, and which of them confirmed windows cover.

    ``told_text`` and ``told_place`` say where confirmed windows begin: one place of each.
    Texts are read as one byte a character, words between single spaces.
    """
    parts = list(split_words(texts, spaced(False)))
    confirmed, phrases = [], set()
    for part in parts:
        mine = (told_text >= part.first) & (told_text < part.first + part.count)
        at = part.bounds[told_text[mine] - part.first] + told_place[mine]
        if not len(at):
            continue
        confirmed.append(part.sequence_hashes(at, window))
        starts, anchors, hashes = windows_and_anchors(part, window)
        owners = anchors[np.searchsorted(starts, at)]
        wanted = np.flatnonzero(np.isin(hashes, owners))
        content = part.data.tobytes()
        _, first = np.unique(hashes[wanted], return_index=True)
        for i in wanted[first]:
            spans = zip(part.starts[i : i + PHRASE_WORDS], part.ends[i : i + PHRASE_WORDS], strict=True)
            phrases.add(b" ".join(content[a:b] for a, b in spans))
    known = np.unique(np.concatenate(confirmed)) if confirmed else np.zeros(0, dtype=np.uint64)
    automaton = _automaton(phrases) if phrases else None
    reach = window - PHRASE_WORDS
    for part in parts:
        content = part.data.tobytes()
        for i in range(part.count):
            a, b = int(part.bounds[i]), int(part.bounds[i + 1])
            words = content[part.starts[a] : part.ends[b - 1]].split() if a < b else []
            gone = np.zeros(b - a, dtype=bool)
            if automaton is not None and b - a >= window:
                ends = [end for end, _ in automaton.iter(f" {b' '.join(words).decode('latin-1')} ")]
                if ends:
                    gone = _covered(part, a, b, np.array(ends), known, window, reach)
            yield part.first + i, words, gone


def _covered(
    part: Words, a: int, b: int, ends: np.ndarray, known: np.ndarray, window: int, reach: int
) -> np.ndarray:
    """The words of one text under confirmed windows, given where phrases end in it."""
    n = b - a
    # With single spaces and one before, the space after word k is at this character.
    after = np.cumsum(part.ends[a:b] - part.starts[a:b] + 1)
    phrase = np.searchsorted(after, ends) - PHRASE_WORDS + 1
    near = np.zeros(n + 1, dtype=np.int64)
    np.add.at(near, np.maximum(phrase - reach, 0), 1)
    np.add.at(near, phrase + 1, -1)
    starts = np.flatnonzero(np.cumsum(near[:n])[: n - window + 1] > 0)
    hashes = part.sequence_hashes(a + starts, window)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = starts[known[at] == hashes]
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + window, -1)
    return np.cumsum(change[:n]) > 0


def _remove(window: int, with_text: bool):
    def run(table: pa.Table) -> pa.Table:
        told = table.filter(pc.is_valid(table["packed"]))
        texts = table.filter(pc.is_null(table["packed"]))
        keys, ids = np.asarray(texts["key"]), texts["id"].to_pylist()
        told_key, told_place = unpack(told["packed"], _PLACE)
        order = np.argsort(keys, kind="stable")
        told_text = order[np.searchsorted(keys, told_key, sorter=order)] if len(keys) else told_key
        rows: list[tuple] = []
        # With 64-bit offsets all chunks fit one array, however many bytes they have.
        content = pa.chunked_array(texts["text"].cast(pa.large_string()).chunks, pa.large_string()).combine_chunks()
        for i, words, gone in covered_words(content, told_text, told_place, window):
            kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g) if gone.any() else b" ".join(words)
            rows.append((ids[i], len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
        out = {
            "id": pa.array(columns[0], pa.int64()),
            "n_words": pa.array(columns[1], pa.int64()),
            "n_removed": pa.array(columns[2], pa.int64()),
            "kept_sha256": pa.array(columns[3], pa.string()),
        }
        if with_text:
            out["kept_text"] = pa.array(columns[4], pa.binary()).cast(pa.string())
        return pa.table(out)

    return run


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 35,
    with_text: bool = False,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per document: words, words removed, and the digest (or also the text) of what is left.

    A word goes if a window of ``window`` words over it also begins anywhere else, in the same
    document or another; all windows are judged on the input. Words are between ASCII spaces,
    unchanged; what is left is joined by single spaces. Null, empty and short texts lose
    nothing. Every row is a document of its own, also one without an id or with a repeated id:
    copies remove one another. Other columns are not read. An empty table gives an empty result.
    """
    if window <= PHRASE_WORDS:
        raise ValueError(f"window must be over {PHRASE_WORDS} words")
    spark = docs.sparkSession
    buckets = bucket_count(spark, 2)
    # One number comes back. A shard is read as one group: it has so many bytes of text, whatever
    # the session's number of partitions, or one longer text.
    size = docs.agg(F.sum(F.octet_length(text_column)).alias("bytes")).first()["bytes"] or 0
    shards = max(buckets, -(-size // shard_bytes))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    texts = texts.select(F.xxhash64("id", "text").alias("key"), "text", "id")
    anchors = texts.mapInArrow(_pack_anchors(window, buckets), PACKED).groupBy("bucket")
    recurring = stage(anchors.applyInArrow(_recurring_anchors, "anchor long"), "anchors")
    bitmap = spark.sparkContext.broadcast(collect_bitmap(recurring, "anchor", recurring.count()))
    windows = texts.mapInArrow(_pack_windows(bitmap, window, buckets), PACKED).groupBy("bucket")
    told = windows.applyInArrow(_confirmed(shards), PACKED)
    shard = texts.mapInArrow(_with_shard(shards), "bucket int, key long, text string, id long")
    both = shard.withColumn("packed", F.lit(None).cast("binary")).unionByName(
        told.select("bucket", "packed"), allowMissingColumns=True
    )
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return both.groupBy("bucket").applyInArrow(_remove(window, with_text), schema).withColumnRenamed("id", id_column)


def _with_shard(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = bucket_of(mix(np.asarray(batch.column(0)).astype(np.uint64)), shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), *batch.columns], names=["bucket", "key", "text", "id"]
            )

    return run
