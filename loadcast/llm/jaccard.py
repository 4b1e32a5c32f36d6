"""Exact Jaccard self-join over word shingles, by relations between sets.

1. Every shingle of every text goes, packed, to the task of its hash, which finds those that
   more than one text holds. Only such shingles can link texts.
2. Each text gets its shared shingles back, ordered by rarity. A text with too few of them
   has no partner. The others are listed under the rare shingles of their prefix, with their
   size and the shingle's position: two texts over the threshold meet in the list of the
   first shingle that they share.
3. A list is cut into blocks by size, a factor of ``100 / percent`` each, so partners are in one
   block or in two that follow each other. What comes after a shingle's position bounds how
   large a partner can be: a text is copied into the next block only if its position lets it
   have a partner there. Blocks that no position reaches are skipped before any pair is formed.
   A block is not joined with itself. It has a leader, the member with the fewest shingles of
   its own; each member is compared with the leader once, and the difference is kept.
4. The other pairs of a leader's members follow from those differences without reading the
   sets again: ``|x & y| = |L| - |L\\x or L\\y| + |x\\L and y\\L|``. Pairs of two partners of
   the leader are linked through it. Members are in blocks by size and by overlap with the
   leader; a block that cannot reach the threshold is skipped whole.
5. Links are reduced to components by rounds of smallest labels.

Texts with equal sets are one class from the start, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bitmap import Bitmap, collect_bitmap
from loadcast.llm.graph import components
from loadcast.llm.packing import PACKED, Packer, bucket_count, bucket_of, of_kind, unpack
from loadcast.llm.words import mix, spaced, split_words
from loadcast.session import stage

SHINGLES, TEXTS = 0, 1
_SHINGLE = np.dtype([("hash", "<u8"), ("key", "<i8")])
_SHARED = np.dtype([("hash", "<u8"), ("key", "<i8"), ("held_by", "<u4")])
_TEXT = np.dtype([("key", "<i8"), ("id", "<i8"), ("has_id", "u1"), ("size", "<i8"), ("sum_a", "<i8"), ("sum_b", "<i8")])
_SALT = np.uint64(0xA0761D6478BD642F)
# Members of a leader that are compared among each other: blocks of the fewest members are used
# until there would be too many of them, then blocks grow to the most.
FEWEST_MEMBERS, MOST_BLOCKS, MOST_MEMBERS = 256, 32, 4096


def needed(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Shingles that a set must share with any partner."""
    return -(-percent * size // 100)


def linked(overlap: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether ``100 * overlap >= percent * union``, given the sum of both sizes."""
    return (100 + percent) * overlap >= percent * sizes


def text_sets(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, ordered by text."""
    order = np.argsort((text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    near_text, near = text[order], hashes[order]
    same = (near_text[1:] == near_text[:-1]) & ((near[1:] >> np.uint64(20)) == (near[:-1] >> np.uint64(20)))
    if np.any(near[1:][same] != near[:-1][same]):
        order = np.lexsort((hashes, text))
        near_text, near = text[order], hashes[order]
    new = np.ones(len(near), dtype=bool)
    new[1:] = (near_text[1:] != near_text[:-1]) | (near[1:] != near[:-1])
    return near_text[new], near[new]


def row_keys(ids: pa.Array, digests: np.ndarray, repeated: Bitmap | None) -> np.ndarray:
    """A key for each text: twice its id, or an odd digest where the id may not tell texts apart.

    Ids are close to each other and compress well, digests do not. ``repeated`` never misses an
    id that several rows have.
    """
    known = np.asarray(pc.fill_null(ids, 0))
    apart = np.asarray(pc.is_null(ids)) | (np.abs(known) >= 1 << 62)
    if repeated is not None:
        apart |= repeated.has(mix(known.astype(np.uint64)))
    return np.where(apart, digests | 1, known << 1)


def repeated_ids(texts: DataFrame) -> Bitmap | None:
    """The ids that several rows have, as a bitmap of bounded size; None without any."""
    often = texts.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    often = stage(often.mapInArrow(_mixed, "hash long"), "repeated-ids")
    count = often.count()
    return collect_bitmap(often, "hash", count) if count else None


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = mix(np.asarray(batch.column(0)).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values)], names=["hash"])


def _pack_sets(words: int, buckets: int, homes: int, repeated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Packer(_SHINGLE, buckets, SHINGLES)
        texts = Packer(_TEXT, homes, TEXTS)
        for batch in batches:
            keys = row_keys(batch.column(2), np.asarray(batch.column(0)), repeated.value if repeated else None)
            ids = np.asarray(pc.fill_null(batch.column(2), 0))
            has_id = np.asarray(pc.is_valid(batch.column(2)).cast(pa.uint8()))
            for part in split_words(batch.column(1), spaced(fold_case=True)):
                rows = slice(part.first, part.first + part.count)
                own = keys[rows]
                text, hashes = text_sets(*part.shingles(words))
                yield from shingles.add(bucket_of(hashes, buckets), hashes, own[text])
                total = np.zeros((2, len(hashes) + 1), dtype=np.uint64)
                np.cumsum(mix(hashes), out=total[0, 1:])
                np.cumsum(mix(hashes ^ _SALT), out=total[1, 1:])
                at = np.searchsorted(text, np.arange(part.count + 1))
                sums = (total[:, at[1:]] - total[:, at[:-1]]).view(np.int64)
                place = bucket_of(mix(own.astype(np.uint64)), homes)
                yield from texts.add(place, own, ids[rows], has_id[rows], np.diff(at), sums[0], sums[1])
        yield from shingles.flush()
        yield from texts.flush()

    return run


def _shared_shingles(homes: int):
    """Of the shingles of a bucket, those of two texts or more, sent on to their texts."""

    def run(table: pa.Table) -> pa.Table:
        hashes, keys = unpack(of_kind(table, SHINGLES), _SHINGLE)
        order = np.lexsort((keys, hashes))
        hashes, keys = hashes[order], keys[order]
        # Equal rows are one text.
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])
        hashes, keys = hashes[new], keys[new]
        heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, int)
        held = np.diff(np.append(heads, len(hashes)))
        held_by = np.repeat(held, held)
        keep = held_by > 1
        hashes, keys, held_by = hashes[keep], keys[keep], held_by[keep]
        order = np.argsort(keys, kind="stable")
        hashes, keys, held_by = hashes[order], keys[order], held_by[order]
        out = Packer(_SHARED, homes, SHINGLES)
        rows = [*out.add(bucket_of(mix(keys.astype(np.uint64)), homes), hashes, keys, held_by), *out.flush()]
        passed = table.filter(pc.equal(table["kind"], TEXTS))
        return pa.concat_tables([passed, pa.Table.from_batches(rows, schema=passed.schema)])

    return run


_SET = "key long, id long, size long, sum_a long, sum_b long, n_shared long, shared binary"
_SET_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("key", "id", "size", "sum_a", "sum_b", "n_shared")] + [("shared", pa.binary())]
)


def _ordered_sets(percent: int):
    """One row per row of the table.

    ``shared`` has the shared shingles of the text by rarity, once for equal rows, or null if
    there are too few.
    """

    def run(table: pa.Table) -> pa.Table:
        hashes, keys, held_by = unpack(of_kind(table, SHINGLES), _SHARED)
        own, ids, has_id, size, sum_a, sum_b = unpack(of_kind(table, TEXTS), _TEXT)
        by_key = np.argsort(own, kind="stable")
        own, ids, has_id, size, sum_a, sum_b = (c[by_key] for c in (own, ids, has_id, size, sum_a, sum_b))
        first = np.ones(len(own), dtype=bool)
        first[1:] = own[1:] != own[:-1]
        order = np.lexsort((hashes, held_by, keys))
        hashes, keys = hashes[order], keys[order]
        start, stop = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
        count = stop - start
        enough = first & (count >= needed(size, percent)) & (count > 0)
        shared = [hashes[a:b].tobytes() if ok else None for a, b, ok in zip(start, stop, enough, strict=True)]
        return pa.Table.from_arrays(
            [
                pa.array(own),
                pa.array(ids, mask=has_id == 0),
                *(pa.array(c) for c in (size, sum_a, sum_b, count)),
                pa.array(shared, pa.binary()),
            ],
            schema=_SET_SCHEMA,
        )

    return run


def size_block(size: int | np.ndarray, percent: int) -> np.ndarray:
    """Blocks of sizes: partners are in one block, or in two that follow each other."""
    return np.floor(np.log(np.maximum(size, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def largest_partner(size: np.ndarray, position: np.ndarray, percent: int) -> np.ndarray:
    """The most shingles of a partner whose first common shingle is at this position.

    Both share what is there and after at most: ``overlap <= size - position``.
    """
    by_size = 100 * size // percent
    by_position = (100 + percent) * (size - position) // percent - size
    return np.minimum(by_size, by_position)


def list_entries(size: int, own: int, count: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places among a text's shared shingles, and the blocks of their lists that it goes to.

    Its prefix is listed in the block of its own size, and in the next one where a partner that
    large can begin at this position. A position with no partner at all is not listed.
    """
    kept = min(max(size - needed(size, percent) + 1 - own, 0), count)
    place = np.arange(kept)
    most = largest_partner(np.full(kept, size), own + place, percent)
    home, reach = size_block(size, percent), size_block(most, percent)
    some = most >= needed(size, percent)
    further = some & (reach > home)
    return np.concatenate([place[some], place[further]]), np.concatenate(
        [np.full(some.sum(), home), np.full(further.sum(), home + 1)]
    ).astype(np.int32)


def _lists(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, counts = (np.asarray(batch.column(i)) for i in range(3))
            own = sizes - counts
            shingles, blocks, taken = [np.zeros(0, "<i8")], [np.zeros(0, np.int32)], []
            for shared, size, lone, count in zip(batch.column(3), sizes, own, counts, strict=True):
                place, block = list_entries(int(size), int(lone), int(count), percent)
                shingles.append(np.frombuffer(shared.as_buffer(), dtype="<i8")[place])
                blocks.append(block)
                taken.append(len(place))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(shingles)),
                    pa.array(np.concatenate(blocks)),
                    pa.array(np.repeat(keys, taken)),
                    pa.array(np.repeat(own, taken)),
                ],
                names=["shingle", "block", "member", "own"],
            )

    return run


_DIFF = "leader long, leader_size long, member long, size long, overlap long, missing binary, extra binary"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each member lacks of its leader's set, as places there, and what it has besides."""
    for batch in batches:
        overlap, missing, extra = [], [], []
        for member, leader in zip(batch.column("shared"), batch.column("leader_shared"), strict=True):
            mine = np.frombuffer(member.as_buffer(), dtype="<u8")
            theirs = np.frombuffer(leader.as_buffer(), dtype="<u8")
            order = np.argsort(theirs)
            at = np.searchsorted(theirs, mine, sorter=order)
            place = order[np.minimum(at, len(theirs) - 1)]
            hit = theirs[place] == mine
            gone = np.ones(len(theirs), dtype=bool)
            gone[place[hit]] = False
            overlap.append(int(hit.sum()))
            missing.append(np.flatnonzero(gone).astype("<u4").tobytes())
            extra.append(mine[~hit].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("leader", "leader_size", "member", "size")),
                pa.array(overlap, pa.int64()),
                pa.array(missing, pa.binary()),
                pa.array(extra, pa.binary()),
            ],
            names=["leader", "leader_size", "member", "size", "overlap", "missing", "extra"],
        )


class _Postings:
    """Which members hold a value: one index for what is missing, one for what is extra."""

    def __init__(self, values: list[np.ndarray]) -> None:
        flat = np.concatenate(values) if values else np.zeros(0, dtype="<u8")
        holder = np.repeat(np.arange(len(values)), [len(v) for v in values])
        order = np.argsort(flat, kind="stable")
        self.flat, self.holder, self.n = flat[order], holder[order], len(values)

    def common(self, values: np.ndarray) -> np.ndarray:
        """How many of the values each member holds."""
        a, b = np.searchsorted(self.flat, values), np.searchsorted(self.flat, values, side="right")
        held = [self.holder[i:j] for i, j in zip(a, b, strict=True) if i < j]
        return np.bincount(np.concatenate(held), minlength=self.n) if held else np.zeros(self.n, dtype=np.int64)


def member_links(
    ids: np.ndarray,
    sizes: np.ndarray,
    overlap: np.ndarray,
    missing: list[np.ndarray],
    extra: list[np.ndarray],
    asking: np.ndarray,
    percent: int,
) -> list[tuple[int, int]]:
    """Links of the members ``asking`` with all given members, as a spanning forest.

    Members are in blocks of equal size, overlap with the leader and surplus over it. Two
    members share at most ``min(overlap) + min(surplus)`` shingles: blocks below the threshold
    are skipped before any posting is read.
    """
    n_missing, n_extra = (np.array([len(v) for v in values], dtype=np.int64) for values in (missing, extra))
    shape, block = np.unique(np.stack([sizes, overlap, n_extra], axis=1), axis=0, return_inverse=True)
    block = block.reshape(-1)
    lacks, has = _Postings(missing), _Postings(extra)
    parent = np.arange(len(ids))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    # What one member can share with the leader is what both of them list as shared.
    listed = overlap + n_missing
    for i in np.flatnonzero(asking):
        bound = np.minimum(shape[:, 1], overlap[i]) + np.minimum(shape[:, 2], n_extra[i])
        open_block = linked(bound, shape[:, 0] + sizes[i], percent)
        mates = open_block[block]
        mates[i] = False
        if not mates.any():
            continue
        union_missing = n_missing + n_missing[i] - lacks.common(missing[i])
        common = listed[i] - union_missing + has.common(extra[i])
        for j in np.flatnonzero(mates & linked(common, sizes + sizes[i], percent)):
            a, b = root(i), root(int(j))
            if a != b:
                parent[a] = b
                out.append((int(ids[i]), int(ids[j])))
    return out


def _group_links(percent: int):
    """Links among the members of one leader, for one pair of their blocks."""

    def run(table: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        key = np.stack([np.asarray(table[c]) for c in ("leader", "row", "column")], axis=1)
        order = np.lexsort(key.T[::-1])
        key = key[order]
        heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        table = table.take(pa.array(order))
        for a, b in zip(heads, np.append(heads[1:], len(key)), strict=True):
            part = table.slice(a, b - a)
            ids, sizes, overlap = (np.asarray(part[c]) for c in ("member", "size", "overlap"))
            links += member_links(
                ids,
                sizes,
                overlap,
                [np.frombuffer(x.as_buffer(), dtype="<u4") for x in part["missing"]],
                [np.frombuffer(x.as_buffer(), dtype="<u8") for x in part["extra"]],
                np.asarray(part["asks"]),
                percent,
            )
        return pa.table(
            {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())}
        )

    return run


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of equal sets: enough of them to connect what is connected."""
    buckets = bucket_count(sets.sparkSession, 4)
    one_each = sets.where("size > 0").groupBy("size", "sum_a", "sum_b").agg(F.min("key").alias("key"))
    able = sets.where(F.col("shared").isNotNull())
    able = stage(able.join(one_each.select("key"), "key", "left_semi"), "able")
    lists = able.select("key", "size", "n_shared", "shared").mapInArrow(
        _lists(percent), "shingle long, block int, member long, own long"
    )
    leaders = (
        lists.groupBy("shingle", "block")
        .agg(F.min(F.struct("own", "member")).alias("first"), F.count("*").alias("held"))
        .where("held > 1")
        .select("shingle", "block", F.col("first.member").alias("leader"))
    )
    pairs = lists.join(leaders, ["shingle", "block"]).where("leader != member").select("leader", "member").distinct()
    of_member = able.select(F.col("key").alias("member"), "size", "shared")
    of_leader = able.select(
        F.col("key").alias("leader"), F.col("size").alias("leader_size"), F.col("shared").alias("leader_shared")
    )
    told = stage(
        pairs.join(of_member, "member").join(of_leader, "leader").mapInArrow(_differences, _DIFF), "differences"
    )
    partner = (100 + percent) * F.col("overlap") >= percent * (F.col("size") + F.col("leader_size"))
    told = told.withColumn("asks", ~partner)
    direct = told.where("not asks").select(F.col("leader").alias("a"), F.col("member").alias("b"))
    sizes = (
        told.groupBy("leader")
        .agg(F.count("*").alias("members"), F.count_if("asks").alias("asking"))
        .where("members > 1 and asking > 0")
        .withColumn("of", F.greatest(F.lit(FEWEST_MEMBERS), F.least(F.col("members") / MOST_BLOCKS, F.lit(MOST_MEMBERS))))
        .select("leader", F.ceil(F.col("members") / F.col("of")).cast("int").alias("blocks"))
    )
    placed = told.join(sizes, "leader").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # A pair of blocks sees the asking members of its row and all members of its column.
    as_row = placed.where("asks").select("*", F.col("block").alias("row"), F.explode(every).alias("column"))
    as_column = placed.select("*", F.explode(every).alias("row"), F.col("block").alias("column"))
    as_row = as_row.where(F.col("row") != F.col("column"))
    as_column = as_column.withColumn("asks", F.col("asks") & (F.col("row") == F.col("block")))
    cells = as_row.unionByName(as_column).withColumn(
        "cell", F.pmod(F.xxhash64("leader", "row", "column"), F.lit(buckets))
    )
    among = cells.groupBy("cell").applyInArrow(_group_links(percent), "a long, b long")
    return direct.unionByName(among)


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, percent: int = 85
) -> DataFrame:
    """``id_column``, ``n_shingles`` and ``component_id`` of every row.

    Texts link when ``100 * |x & y| >= percent * |x or y|`` over their distinct ``words``-word
    shingles; ``component_id`` is the smallest id that links reach. Words are between ASCII
    spaces, A-Z read as a-z; a text of fewer words is one shingle. Null, empty and blank texts
    have no shingle and link with nothing. Each row is judged by its own text, also one of a
    repeated id; a row without an id has a component as well, whose id is null only if no row in
    it has one. Texts of any length are read whole. Other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    # Shingles are many: small buckets. What is sent back to a text's home is a fraction of them.
    buckets, homes = bucket_count(spark, 4), bucket_count(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    keyed = texts.select(F.xxhash64("id", F.lit("/"), "text").alias("digest"), "text", "id")
    often = repeated_ids(texts)
    repeated = spark.sparkContext.broadcast(often) if often else None
    packed = keyed.mapInArrow(_pack_sets(words, buckets, homes, repeated), PACKED)
    shared = packed.groupBy("bucket").applyInArrow(_shared_shingles(homes), PACKED)
    sets = stage(shared.groupBy("bucket").applyInArrow(_ordered_sets(percent), _SET), "sets")
    labels = components(_links(sets, percent)).select(F.col("node").alias("first_key"), "label")
    same = ["size", "sum_a", "sum_b"]
    classes = (
        sets.where("size > 0")
        .groupBy(*same)
        .agg(F.min("key").alias("first_key"), F.min("id").alias("first_id"))
        .join(labels, "first_key", "left")
        .select(*same, "first_id", F.coalesce("label", "first_key").alias("label"))
    )
    classes = stage(classes, "classes")
    smallest = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    # Written first: then the last join is of two plain shuffles, and Spark can split a class with
    # a large part of all texts.
    named = stage(classes.join(smallest, "label").select(*same, "component_id"), "components")
    return sets.join(named, same, "left").select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
