"""SimHash fingerprints, and links between near ones by tables of pivot distances.

1. A fingerprint is the majority, bit by bit, of the XXH64 hashes of a text's shingles. Equal
   fingerprints are one class from the start, so copies are never paired.
2. The pivot table: the Hamming distances of every distinct fingerprint to reference
   fingerprints. Flipping a bit changes each of them by one, so two fingerprints ``radius``
   apart or nearer differ by ``radius`` at most in every coordinate, and by an even or odd
   number in all of them alike.
3. To meet at all, fingerprints are dealt by bands: with ``radius + 2`` bands, two such
   fingerprints agree in at least two. A pair of bands is a key of 32 bits. A key with many
   fingerprints is split by pivot coordinates: a fingerprint is at home in the cell of its
   first coordinates, and asks in the cells that a partner's coordinates can have. The more
   fingerprints share a key, the more coordinates make up its cells.
4. In a cell the pairs whose coordinates differ too much, the maximum over all pivots, are
   discarded; the survivors are verified. Of a cell's links a spanning forest is kept.
5. Links are reduced to components by rounds of smallest labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.graph import components
from loadcast.llm.packing import bucket_count
from loadcast.llm.words import Words, spaced, split_words
from loadcast.session import stage

WORDS, RADIUS, SEED = 3, 2, 42
BITS = 64
PIVOTS = 16
CELL_ROWS = 512
PAIRS_AT_ONCE = 1 << 20


def _shingle_bytes(part: Words, fold: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a slice with one space after each, and where each begins and ends in that."""
    data = np.append(fold[part.data], np.uint8(32))
    # Only a space follows a word, but for the last word of a text, which no shingle goes beyond.
    keep = np.zeros(len(data) + 1, dtype=np.int64)
    keep[part.starts] += 1
    np.subtract.at(keep, part.ends, 1)
    inside = np.cumsum(keep[:-1]) > 0
    gaps = part.ends[~inside[part.ends]]
    data[gaps] = 32
    inside[gaps] = True
    before = np.concatenate([[0], np.cumsum(inside)])
    return data[inside].tobytes(), before[part.starts], before[part.ends]


def slice_fingerprints(part: Words, fold: np.ndarray, words: int) -> np.ndarray:
    """The fingerprint of each text of a slice, as unsigned numbers; 0 of a text without words."""
    out = np.zeros(part.count, dtype=np.uint64)
    lengths = part.lengths
    if not len(part.starts):
        return out
    content, starts, ends = _shingle_bytes(part, fold)
    at, _ = part.sequences(words)
    short = np.flatnonzero((lengths > 0) & (lengths < words))
    first = np.concatenate([at, part.bounds[:-1][short]])
    last = np.concatenate([at + words - 1, part.bounds[1:][short] - 1])
    text = np.concatenate([part.text[at], short])
    order = np.argsort(text, kind="stable")
    text = text[order]
    hashed = xxhash.xxh64_intdigest
    places = zip(starts[first[order]].tolist(), ends[last[order]].tolist(), strict=True)
    hashes = np.array([hashed(content[a:b], SEED) for a, b in places], dtype=np.uint64)
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    count = np.diff(np.append(heads, len(text)))
    for bit in range(BITS):
        held = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), heads)
        out[text[heads]] |= (2 * held > count.astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = spaced(fold_case=True)
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for part in split_words(batch.column(1), letters):
                out[part.first : part.first + part.count] = slice_fingerprints(part, letters.fold, words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["id", "fp"])

    return run


def pivots(count: int = PIVOTS) -> list[Column]:
    """Reference fingerprints: the hashes of the first numbers, the same in every run."""
    return [F.xxhash64(F.lit(i).cast("long")) for i in range(count)]


def _bands(radius: int) -> list[Column]:
    """``fp`` cut into ``radius + 2`` runs of bits."""
    edges = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    return [
        F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
        for a, b in zip(edges, edges[1:], strict=False)
    ]


def offsets(coordinates: int, radius: int) -> list[list[int]]:
    """How the first coordinates of a partner can differ, one of each pair of opposites.

    After ``r`` flipped bits each coordinate has changed by ``-r``, ``-r + 2``, ... or ``r``.
    """
    steps = {s for r in range(1, radius + 1) for s in product(range(-r, r + 1, 2), repeat=coordinates)}
    return [list(s) for s in sorted(steps | {(0,) * coordinates}) if s >= (0,) * coordinates]


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the links between the places ``a`` and ``b`` to connect what they connect."""
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(i), root(j)
        if x != y:
            parent[x] = y
            out.append((int(ids[i]), int(ids[j])))
    return out


def cell_pairs(
    asking: np.ndarray, home: np.ndarray, table_a: np.ndarray, table_b: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the asking and home fingerprints that are ``radius`` apart or nearer.

    The tables have a row of pivot distances for each. Block by block, pivot after pivot, the
    pairs with too large a difference go; what is left after the last one is verified.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int))]
    # By the first coordinate: what an asking fingerprint can meet is one run of the others.
    order = np.argsort(table_b[:, 0], kind="stable")
    first = table_b[order, 0]
    low = np.searchsorted(first, table_a[:, 0] - radius)
    high = np.searchsorted(first, table_a[:, 0] + radius, side="right")
    width = high - low
    done = np.concatenate([[0], np.cumsum(width)])
    start = 0
    while start < len(asking):
        stop = max(int(np.searchsorted(done, done[start] + PAIRS_AT_ONCE, side="right")) - 1, start + 1)
        a = np.repeat(np.arange(start, stop), width[start:stop])
        b = order[np.arange(done[start], done[stop]) - np.repeat(done[start:stop] - low[start:stop], width[start:stop])]
        for pivot in range(1, table_a.shape[1]):
            near = np.abs(table_a[a, pivot] - table_b[b, pivot]) <= radius
            a, b = a[near], b[near]
        near = np.bitwise_count(asking[a] ^ home[b]) <= radius
        near &= asking[a] != home[b]
        found.append((a[near], b[near]))
        start = stop
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _cell_links(radius: int):
    def run(table: pa.Table) -> pa.Table:
        bands, value, cell, fp, asks = (np.asarray(table[c]) for c in ("bands", "value", "cell", "fp", "asks"))
        bits = fp.view(np.uint64)
        near = np.stack(
            [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in table["pivots"].combine_chunks()]
        ).astype(np.int16)
        order = np.lexsort((cell, value, bands))
        key = np.stack([bands.astype(np.int64), value, cell], axis=1)[order]
        heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        links: list[tuple[int, int]] = []
        for i, j in zip(heads, np.append(heads[1:], len(key)), strict=True):
            rows = order[i:j]
            asking, home = rows[asks[rows]], rows[~asks[rows]]
            if not len(asking) or not len(home):
                continue
            a, b = cell_pairs(bits[asking], bits[home], near[asking], near[home], radius)
            links += forest(fp[rows], *(np.searchsorted(rows, x) for x in (asking[a], home[b])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``a`` and ``b``: links between distinct fingerprints ``fp``, enough to connect what is connected."""
    spark = fingerprints.sparkSession
    distance = [F.bit_count(F.col("fp").bitwiseXOR(p)) for p in pivots()]
    # One byte for each distance.
    table = F.unhex(F.concat(*(F.lpad(F.hex(d.cast("long")), 2, "0") for d in distance)))
    bands = _bands(radius)
    keys = [
        F.struct(F.lit(i).alias("bands"), (bands[x] * F.lit(1 << 32) + bands[y]).alias("value"))
        for i, (x, y) in enumerate(combinations(range(radius + 2), 2))
    ]
    dealt = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")
    shared = dealt.groupBy("bands", "value").agg(F.count("*").alias("held")).where("held > 1")
    met = stage(dealt.join(shared, ["bands", "value"]), "bands")
    # Coordinates that make up a cell: one more for each factor of eight.
    depth = F.ceil(F.log(8.0, F.col("held") / F.lit(float(cell_rows))))
    most = PIVOTS - 1
    met = met.withColumn("depth", F.greatest(F.least(depth, F.lit(most)), F.lit(0)).cast("int"))
    deepest = (met.agg(F.max("depth")).first() or [0])[0] or 0
    met = met.withColumn("pivots", table)
    moves = F.array(
        *(
            F.array(*(F.array(*(F.lit(s) for s in step)) if step else F.array().cast("array<int>") for step in offsets(k, radius)))
            for k in range(deepest + 1)
        )
    )
    home = F.array(*(d.cast("int") for d in distance))
    at = F.slice(home, F.lit(1), F.col("depth"))
    rows = met.select("bands", "value", "fp", "pivots", at.alias("at"), F.element_at(moves, F.col("depth") + 1).alias("moves"))
    asking = rows.select("*", F.explode("moves").alias("move")).withColumn(
        "at", F.zip_with("at", "move", lambda c, m: c + m)
    )
    cells = (
        rows.select("bands", "value", "fp", "pivots", "at", F.lit(False).alias("asks"))
        .unionByName(asking.select("bands", "value", "fp", "pivots", "at", F.lit(True).alias("asks")))
        .withColumn("cell", F.xxhash64("at"))
        .drop("at")
    )
    buckets = bucket_count(spark, 8)
    bucket = F.pmod(F.xxhash64("bands", "value", "cell"), F.lit(buckets))
    return cells.groupBy(bucket.alias("bucket")).applyInArrow(_cell_links(radius), "a long, b long")


def simhash_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """``id_column``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id
    that links reach. Words are between ASCII spaces, A-Z read as a-z; shingles have ``words``
    words, repeated ones count each time; a text of fewer words is one shingle. Null, empty and
    blank texts have fingerprint zero and link like any other. Each row is judged by its own
    text, also one with a repeated id; a row without an id has a component as well, whose id is
    null only if no row in it has one. Texts of any length are read whole. Other columns are not
    read. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    rows = stage(texts.mapInArrow(_fingerprints(words), "id long, fp long"), "fingerprints")
    # Equal fingerprints collapse before the shuffle: a hot one is one row for each task.
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    labels = components(fingerprint_links(classes.select("fp"), radius)).select(F.col("node").alias("fp"), "label")
    labelled = classes.join(labels, "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    # Written first: the last join is of two plain shuffles, and Spark can split a hot fingerprint.
    named = stage(labelled.join(smallest, "label").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
