"""Deep forests: large nodes split by shuffled histograms, small ones grown from their own rows.

Spark ML keeps the statistics of all bins of every open node in every partition, and shuffles them.
Nearly all nodes of a deep tree have few rows, so that this costs far more than their rows do. Here a
node is split that way only while it has more rows than a task may hold. The rows of a smaller node
are shuffled once, to one group, and its subtree is grown from them within a task.

The trees are Spark ML's otherwise: at most ``maxBins`` bins of each feature, a Poisson(1) number of
copies of each row in each tree, all features at each split, the split of the largest fall in variance,
and the mean of the trees.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

# From this depth on, trees are grown here. Spark ML grows shallower ones, whose nodes have many rows.
DEEP = 12
# Rows, copies included, from which one task grows a subtree: about 60 bytes each.
PIECE_ROWS = 4_000_000
# Rows of a partition that deals rows out to trees.
DEALT_ROWS = 100_000
# Rows times trees whose drawn rows are shuffled at once: about 8 bytes of disk each.
SHUFFLED_ROWS = 200_000_000
# Spark's setting that deletes the shuffle files of a query at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Nodes whose histograms a task holds at once.
NODES_AT_ONCE = 512
# Rows that are summed at once, so that they stay in a core's cache.
ROWS_AT_ONCE = 131_072
# Rows of a node, on average, from which a node is known better from its parent and its sibling than from its rows.
MANY_ROWS = 128
# Inner nodes up to which rows are passed down node by node, not level by level.
FEW_NODES = 64
# Ranks at which the values of a feature are looked at, to place its thresholds.
RANKS = 10_000
# Rows whose values are put in order at once for that.
SUMMED_ROWS = 400_000
# The cut of a node that is not split: no bin is larger.
LEAF = 255
# Share of a node's sum of squares below which its targets are equal, but for rounding.
EQUAL = 1e-12
# Share by which falls differ by rounding alone.
TIE = 1e-9

_DRAWN = np.cumsum([exp(-1) / factorial(k) for k in range(16)])
_BLOCK = "block long, bins binary, y binary"
_SUMS = "tree int, node int, sums binary, low double, high double"
_SPLIT = "tree int, node int, feature int, cut int, value double, gain double, n_left long, n_right long"
_PIECE = "tree int, node int, feature binary, cut binary, left binary, value binary, gains array<double>"


@dataclass
class Nodes:
    """A tree as arrays. A row goes to ``left`` or, if its bin is above the cut, to the node after it."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    # Nodes still to be split by histograms, and those left to a task.
    open: set[int] = field(default_factory=set)
    pieces: set[int] = field(default_factory=set)
    gains: list[float] = field(default_factory=list)

    def add(self, depth: int, rows: int, most: int, piece_rows: int) -> None:
        node = len(self.left)
        for values, value in ((self.feature, 0), (self.cut, LEAF), (self.left, node), (self.value, 0.0), (self.depth, depth)):
            values.append(value)
        (self.pieces if rows <= piece_rows or depth >= most else self.open).add(node)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.uint8), np.array(self.cut, np.uint8), np.array(self.left, np.int32)


def is_deep(regressor: RandomForestRegressor) -> bool:
    """Whether the forest is deep and asks for nothing but what ``grow_forest`` does."""
    strategy, trees = regressor.getFeatureSubsetStrategy(), regressor.getNumTrees()
    return (
        regressor.getMaxDepth() >= DEEP
        and regressor.getMaxBins() < LEAF
        and (strategy == "all" or (strategy == "auto" and trees == 1))
        and regressor.getBootstrap()
        and regressor.getSubsamplingRate() == 1.0
        and regressor.getMinInfoGain() == 0.0
        and regressor.getMinWeightFractionPerNode() == 0.0
        and not (regressor.isDefined(regressor.weightCol) and regressor.getWeightCol())
        and not regressor.getLeafCol()
    )


def thresholds(values: Sequence[float], bins: int) -> list[float]:
    """At most ``bins - 1`` cuts of a feature, midway between values; all, if it has few values."""
    ranked = np.asarray(values, float)
    distinct = np.unique(ranked)
    below = np.arange(len(distinct) - 1)
    if len(distinct) > bins:
        places = np.arange(1, bins) * (len(ranked) - 1) // bins
        found = np.unique(np.searchsorted(distinct, ranked[places]))
        below = found[found < len(distinct) - 1]
    return ((distinct[below] + distinct[below + 1]) / 2).tolist()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each feature, of some rows at a time: all values with their counts, or ``RANKS`` of them by rank."""
    parts, size = [], 0

    def summary() -> pa.RecordBatch:
        values, weights = [], []
        for column in np.concatenate(parts).T:
            found, counts = np.unique(column, return_counts=True)
            if len(found) > RANKS:
                found = np.repeat(found, counts)[(np.arange(RANKS) * 2 + 1) * size // (2 * RANKS)]
                counts = np.full(RANKS, size / RANKS)
            values.append(found.tobytes())
            weights.append(counts.astype(float).tobytes())
        columns = [pa.array(range(len(values)), pa.int32()), pa.array(values, pa.binary()), pa.array(weights, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["pos", "found", "counts"])

    for batch in batches:
        if batch.num_rows:
            parts.append(matrix(batch["x"], len(batch["x"][0])))
            size += batch.num_rows
        if size >= SUMMED_ROWS:
            yield summary()
            parts, size = [], 0
    if parts:
        yield summary()


def _ranked(table: pa.Table) -> pa.Table:
    """The values of one feature at ``RANKS`` even ranks, and the least, from the summaries of all tasks."""
    values, weights = (np.concatenate([np.frombuffer(b) for b in table[c].to_pylist()]) for c in ("found", "counts"))
    order = np.argsort(values, kind="stable")
    below = weights[order].cumsum()
    places = np.searchsorted(below, (np.arange(RANKS + 1) / RANKS - 1e-9) * below[-1])
    return pa.table({"pos": table["pos"][:1], "values": pa.array([values[order][places].tolist()], pa.list_(pa.float64()))})


def feature_cuts(known: DataFrame, bins: int) -> list[list[float]]:
    """The thresholds of each feature, from all rows of an array ``x``.

    Ranks are right to a ten-thousandth of the rows; a feature of few values has all of them.
    """
    some = known.select("x").mapInArrow(_summaries, "pos int, found binary, counts binary")
    ranked = some.groupBy("pos").applyInArrow(_ranked, "pos int, values array<double>").collect()
    return [thresholds(r["values"], bins) for r in sorted(ranked)]


def binned(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """One row of bins for each feature."""
    return np.stack([np.searchsorted(c, values[:, f], side="left").astype(np.uint8) for f, c in enumerate(cuts)])


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _pack(cuts: Sequence[Sequence[float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = binned(matrix(batch["x"], len(cuts)), cuts)
                row = {"block": [batch["row"][0].as_py()], "bins": [bins.tobytes()], "y": [batch["y"].to_numpy().tobytes()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("block", pa.int64()), ("bins", pa.binary()), ("y", pa.binary())]))

    return run


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins, targets and numbers of the rows of each block."""
    for batch in batches:
        for block, bins, y in zip(*(batch[n].to_pylist() for n in ("block", "bins", "y")), strict=True):
            target = np.frombuffer(y)
            yield np.frombuffer(bins, np.uint8).reshape(width, -1), target, block + np.arange(len(target))


def copies(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1), from the row's number, the tree and the seed."""
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x += np.uint64((seed * 0xD1342543DE82EF95 + tree * 0xA0761D6478BD642F + 1) % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_DRAWN, (x >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


def walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node at which each row ends. A node that is not split leads to itself."""
    inner = np.flatnonzero(left != np.arange(len(left)))
    if len(inner) <= FEW_NODES:
        # Children come after their parents. Nothing is looked up by row.
        place = np.zeros(bins.shape[1], np.int16)
        for node in inner:
            here = place == node
            place += here * np.int16(left[node] - node)
            place += here & (bins[feature[node]] > cut[node])
        return place.astype(np.int32)
    rows = np.arange(bins.shape[1])
    at = np.zeros(len(rows), np.int32)
    while True:
        below = left[at] + (bins[feature[at], rows] > cut[at])
        if np.array_equal(below, at):
            return at
        at = below.astype(np.int32)


def summed(
    bins: np.ndarray, at: np.ndarray, values: Sequence[np.ndarray | None], spans: list[int], nodes: int, mine: np.ndarray | None
) -> list[np.ndarray]:
    """For each feature, sums of the values over the rows ``mine`` or all, by value, node and bin; None counts rows."""
    out = [np.zeros((len(values), nodes * span)) for span in spans]
    for a in range(0, len(at if mine is None else mine), ROWS_AT_ONCE):
        rows = slice(a, min(a + ROWS_AT_ONCE, len(at))) if mine is None else mine[a : a + ROWS_AT_ONCE]
        node, chosen = at[rows], [None if v is None else v[rows] for v in values]
        for f, span in enumerate(spans):
            if span > 1:
                key = node * span + bins[f][rows]
                for k, v in enumerate(chosen):
                    out[f][k] += np.bincount(key, v, nodes * span)
    return [o.reshape(len(values), nodes, span) for o, span in zip(out, spans, strict=True)]


def best_splits(weight: np.ndarray, target: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For nodes by bins, the bin to cut after and the fall of the sum of squares there, or minus infinity.

    Of falls that are equal, but for rounding, the first one counts.
    """
    lw, ls = weight.cumsum(1), target.cumsum(1)
    whole, mean = lw[:, -1:].copy(), ls[:, -1:] / np.maximum(lw[:, -1:], 1)
    lw, ls = lw[:, :-1], ls[:, :-1]
    rw = whole - lw
    ls -= lw * mean
    fall = ls * ls
    fall /= np.maximum(lw * rw, 1)
    fall[(lw < least) | (rw < least)] = -np.inf
    most = fall.max(1)
    return (fall >= most[:, None] * (1 - TIE)).argmax(1), most * whole[:, 0]


def _histograms(
    trees: dict[int, Nodes], spans: list[int], seed: int, mean: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each open node, over the rows of a task: copies and summed targets of each bin; least and largest target."""
    tops = {t: (n.arrays(), sorted(n.open)) for t, n in trees.items() if n.open}
    sizes = {t: len(n.left) for t, n in trees.items()}
    starts = np.concatenate([[0], np.cumsum(spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((len(nodes), 2, starts[-1])) for t, (_, nodes) in tops.items()}
        ends = {t: np.tile([[np.inf], [-np.inf]], len(nodes)) for t, (_, nodes) in tops.items()}
        for bins, y, rows in _blocks(batches, len(spans)):
            for t, (arrays, nodes) in tops.items():
                slot = np.full(sizes[t], -1)
                slot[nodes] = np.arange(len(nodes))
                weight, at = copies(rows, t, seed), slot[walk(bins, *arrays)]
                mine = np.flatnonzero((weight > 0) & (at >= 0))
                w, at = weight[mine].astype(float), at[mine]
                wy = w * (y[mine] - mean)
                np.minimum.at(ends[t][0], at, y[mine])
                np.maximum.at(ends[t][1], at, y[mine])
                for f, span in enumerate(spans):
                    key = at * span + bins[f, mine]
                    for k, v in enumerate((w, wy)):
                        found = np.bincount(key, v, len(nodes) * span)
                        sums[t][:, k, starts[f] : starts[f + 1]] += found.reshape(-1, span)
        for t, (_, nodes) in tops.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "tree": pa.array([t] * len(nodes), pa.int32()),
                    "node": pa.array(nodes, pa.int32()),
                    "sums": [s.tobytes() for s in sums[t]],
                    "low": ends[t][0],
                    "high": ends[t][1],
                }
            )

    return run


def _choose(spans: list[int], least: int, mean: float) -> Callable[[pa.Table], pa.Table]:
    """The split of one node, from the histograms of all tasks; feature -1 if it has none."""

    def run(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s).reshape(2, -1) for s in table["sums"].to_pylist())
        weight, target = total[:, : spans[0]].sum(1)
        ends = min(table["low"].to_pylist()), max(table["high"].to_pylist())
        value = np.clip(mean + target / max(weight, 1), *ends)
        row = {"feature": -1, "cut": LEAF, "value": value, "gain": 0.0, "n_left": 0, "n_right": 0}
        start = 0
        for f, span in enumerate(spans):
            if span > 1 and ends[0] < ends[1]:
                w, s = total[:, None, start : start + span]
                (place,), (gain,) = best_splits(w, s, least)
                if gain > row["gain"] * (1 + TIE):
                    n_left = int(w[0, : place + 1].sum())
                    row |= {"feature": f, "cut": int(place), "gain": gain, "n_left": n_left, "n_right": int(weight) - n_left}
            start += span
        found = {"tree": table["tree"][0].as_py(), "node": table["node"][0].as_py(), **row}
        ints, longs = ("tree", "node", "feature", "cut"), ("n_left", "n_right")
        types = {n: pa.int32() if n in ints else pa.int64() if n in longs else pa.float64() for n in found}
        return pa.Table.from_pydict({n: [v] for n, v in found.items()}, pa.schema(list(types.items())))

    return run


def _deal(
    trees: dict[int, Nodes], width: int, seed: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The drawn rows of each block, packed by the tree and the piece where they end."""
    tops = {t: (n.arrays(), np.array(sorted(n.pieces), np.int32)) for t, n in trees.items() if n.pieces}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, rows in _blocks(batches, width):
            for t, (arrays, pieces) in tops.items():
                weight = copies(rows, t, seed)
                drawn = np.flatnonzero(weight)
                at = walk(bins[:, drawn], *arrays)
                order = np.argsort(at, kind="stable")
                drawn, at = drawn[order], at[order]
                lows, highs = np.searchsorted(at, pieces, "left"), np.searchsorted(at, pieces, "right")
                parts = [(p, drawn[a:b]) for p, a, b in zip(pieces.tolist(), lows, highs, strict=True) if a < b]
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([t] * len(parts), pa.int32()),
                        "node": pa.array([p for p, _ in parts], pa.int32()),
                        "bins": pa.array([bins[:, i].tobytes() for _, i in parts], pa.binary()),
                        "y": pa.array([y[i].tobytes() for _, i in parts], pa.binary()),
                        "w": pa.array([weight[i].tobytes() for _, i in parts], pa.binary()),
                    }
                )

    return run


def _halves(
    bins: np.ndarray,
    at: np.ndarray,
    w: np.ndarray,
    wy: np.ndarray,
    spans: list[int],
    weight: np.ndarray,
    able: np.ndarray,
    parents: list[np.ndarray],
) -> list[np.ndarray]:
    """Sums of the nodes that may be split: of the smaller child from its rows, of the other from its parent's."""
    right_is_less = weight[1::2] < weight[::2]
    small = np.arange(0, len(weight), 2) + right_is_less
    wanted = able[::2] | able[1::2]
    slot = np.full(len(weight), -1)
    slot[small[wanted]] = np.arange(wanted.sum())
    of_rows = slot[at]
    own = summed(bins, of_rows, (w, wy), spans, int(wanted.sum()), np.flatnonzero(of_rows >= 0))
    out = []
    for mine, both in zip(own, parents, strict=True):
        whole = np.zeros((2, len(weight), mine.shape[2]))
        whole[:, small[wanted]], whole[:, small[wanted] ^ 1] = mine, both[:, wanted] - mine
        out.append(whole[:, able])
    return out


def grow(
    bins: np.ndarray, y: np.ndarray, w: np.ndarray, spans: list[int], depth: int, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A subtree of at most ``depth`` levels: feature, cut, left and value of its nodes; gains of the features.

    All nodes of a level are split together, up to ``NODES_AT_ONCE`` of them.
    """
    w = w.astype(float)
    wy = w * y
    levels, gains = _levels(bins, np.zeros(len(y), np.int64), 1, (w, wy, wy * y), spans, depth, least)
    feature, cut, value = (np.concatenate(part) for part in zip(*levels, strict=True))
    left = np.arange(len(cut), dtype=np.int32)
    # Below its last level a subtree is in order: the next two nodes are the children of the next one that is split.
    split = np.flatnonzero(cut != LEAF)
    left[split] = 1 + 2 * np.arange(len(split))
    return feature, cut, left, value, gains


def _levels(
    bins: np.ndarray,
    at: np.ndarray,
    nodes: int,
    sums: tuple[np.ndarray, np.ndarray, np.ndarray],
    spans: list[int],
    depth: int,
    least: int,
    parents: list[np.ndarray] | None = None,
) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """The levels below ``nodes`` nodes, rows of which have copies, targets and squares to sum; gains of the features.

    Of two siblings with many rows the smaller one is summed; the other is their parent without it.
    """
    if nodes > NODES_AT_ONCE:
        return _parted(bins, at, nodes, sums, spans, depth, least, parents)
    levels, gains = [], np.zeros(len(spans))
    while True:
        weight, target, squares = (np.bincount(at, v, nodes) for v in sums)
        feature, cut = np.zeros(nodes, np.uint8), np.full(nodes, LEAF, np.uint8)
        levels.append((feature, cut, target / weight))
        able = (weight >= 2 * least) & (squares - target**2 / weight > EQUAL * squares)
        if depth == 0 or not able.any():
            return levels, gains
        if len(at) < MANY_ROWS * nodes:
            parents = None
        n_able, slot = int(able.sum()), np.cumsum(able) - 1
        if parents is not None:
            of_bins = _halves(bins, at, sums[:2], spans, weight, able, parents)
        else:
            mine = None if n_able == nodes else np.flatnonzero(able[at])
            of_bins = summed(bins, slot[at], sums[:2], spans, n_able, mine)
        best, which, place = np.zeros(n_able), np.zeros(n_able, np.uint8), np.full(n_able, LEAF, np.uint8)
        for f, span in enumerate(spans):
            if span > 1:
                found, gain = best_splits(*of_bins[f], least)
                more = np.flatnonzero(gain > best * (1 + TIE))
                best[more], which[more], place[more] = gain[more], f, found[more]
        split = best > 0
        if not split.any():
            return levels, gains
        gains += np.bincount(which[split], best[split], len(spans))
        chosen = np.flatnonzero(able)[split]
        feature[chosen], cut[chosen] = which[split], place[split]
        child = np.full(nodes, -1)
        child[chosen] = 2 * np.arange(len(chosen))
        if len(chosen) < nodes:
            mine = np.flatnonzero(child[at] >= 0)
            at, bins, sums = at[mine], bins.take(mine, 1), tuple(v[mine] for v in sums)
        at = child[at] + (bins[feature[at], np.arange(len(at))] > cut[at])
        parents = [s[:, split] for s in of_bins]
        nodes, depth = 2 * len(chosen), depth - 1
        if nodes > NODES_AT_ONCE:
            below, more_gains = _parted(bins, at, nodes, sums, spans, depth, least, parents)
            return levels + below, gains + more_gains


def _parted(
    bins: np.ndarray,
    at: np.ndarray,
    nodes: int,
    sums: tuple[np.ndarray, np.ndarray, np.ndarray],
    spans: list[int],
    depth: int,
    least: int,
    parents: list[np.ndarray] | None,
) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """``_levels`` of many nodes, some at a time, each from its own rows: these stay in a core's cache."""
    # Small numbers are sorted by radix.
    order = np.argsort(at.astype(np.min_scalar_type(nodes)), kind="stable")
    at, bins, sums = at[order], bins.take(order, 1), tuple(v[order] for v in sums)
    # Siblings stay together.
    some = 2 * max(1, NODES_AT_ONCE // (16 if len(at) >= MANY_ROWS * nodes else 4))
    ends = np.searchsorted(at, np.arange(0, nodes + some, some))
    below, gains = [], np.zeros(len(spans))
    for i, first in enumerate(range(0, nodes, some)):
        rows, last = slice(ends[i], ends[i + 1]), min(first + some, nodes)
        above = None if parents is None else [p[:, first // 2 : last // 2] for p in parents]
        mine = tuple(v[rows] for v in sums)
        found, more = _levels(bins[:, rows], at[rows] - first, last - first, mine, spans, depth, least, above)
        below.append(found)
        gains += more
    deep = max(map(len, below))
    return [tuple(map(np.concatenate, zip(*(p[k] for p in below if k < len(p)), strict=True))) for k in range(deep)], gains


def _halves(
    bins: np.ndarray,
    at: np.ndarray,
    values: tuple[np.ndarray, np.ndarray],
    spans: list[int],
    weight: np.ndarray,
    able: np.ndarray,
    parents: list[np.ndarray],
) -> list[np.ndarray]:
    """Sums of the nodes that may be split: of the smaller child from its rows, of the other from its parent's."""
    wanted = able[::2] | able[1::2]
    small = (np.arange(0, len(weight), 2) + (weight[1::2] < weight[::2]))[wanted]
    slot = np.full(len(weight), -1)
    slot[small] = np.arange(len(small))
    of_rows = slot[at]
    own = summed(bins, of_rows, values, spans, len(small), np.flatnonzero(of_rows >= 0))
    out = []
    for mine, both in zip(own, parents, strict=True):
        whole = np.zeros((2, len(weight), mine.shape[2]))
        whole[:, small], whole[:, small ^ 1] = mine, both[:, wanted] - mine
        out.append(whole if able.all() else whole[:, able])
    return out


def _finish(
    trees: dict[int, Nodes], spans: list[int], most: int, least: int
) -> Callable[[pa.Table], pa.Table]:
    """The subtree of one piece, from the rows that all tasks dealt to it."""
    depths = {t: {p: n.depth[p] for p in n.pieces} for t, n in trees.items()}

    def run(table: pa.Table) -> pa.Table:
        tree, node = table["tree"][0].as_py(), table["node"][0].as_py()
        bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(len(spans), -1) for b in table["bins"].to_pylist()], 1)
        y = np.concatenate([np.frombuffer(b) for b in table["y"].to_pylist()])
        w = np.concatenate([np.frombuffer(b, np.uint8) for b in table["w"].to_pylist()])
        centre = float(np.average(y, weights=w))
        *arrays, value, gains = grow(bins, y - centre, w, spans, most - depths[tree][node], least)
        return _piece(tree, node, *arrays, np.clip(value + centre, y.min(), y.max()), gains)

    return run


def _piece(
    tree: int, node: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, value: np.ndarray, gains: np.ndarray
) -> pa.Table:
    types = [("tree", pa.int32()), ("node", pa.int32()), *((n, pa.binary()) for n in ("feature", "cut", "left", "value"))]
    blobs = [feature.astype(np.uint8), cut.astype(np.uint8), left.astype(np.int32), value.astype(float)]
    row = [tree, node, *(b.tobytes() for b in blobs), gains.tolist()]
    schema = pa.schema([*types, ("gains", pa.list_(pa.float64()))])
    return pa.Table.from_pydict({n: [v] for n, v in zip(schema.names, row, strict=True)}, schema)


def grow_forest(
    regressor: RandomForestRegressor, rows: DataFrame, piece_rows: int = PIECE_ROWS, shuffled_rows: int = SHUFFLED_ROWS
) -> DeepForest:
    """The forest of the regressor's settings. ``rows`` are staged: they are read several times.

    Every tree shuffles the rows drawn for it. So many trees at a time do that as disk is meant to hold, in a
    session of their own that deletes their shuffle files when they are staged.
    """
    spark, label = rows.sparkSession, F.col(regressor.getLabelCol()).cast("double")
    bad = F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))
    y = F.when(label.isNull() | F.isnan(label), bad).otherwise(label)
    known = rows.select(vector_to_array(regressor.getFeaturesCol()).alias("x"), y.alias("y"))
    n, mean = known.agg(F.count("*"), F.avg("y")).first()
    if not n:
        raise ValueError("A forest needs rows to learn from")
    cuts = feature_cuts(known, min(regressor.getMaxBins(), n) if n > 1 else 2)
    spans = [len(c) + 1 for c in cuts]
    cores = spark.sparkContext.defaultParallelism
    dealt = known.repartition(max(1, min(2 * cores, n // 1000), -(-n // DEALT_ROWS)))
    numbered = dealt.select(F.monotonically_increasing_id().alias("row"), "x", "y")
    packed = stage(numbered.mapInArrow(_pack(cuts), _BLOCK), "blocks")
    own = spark.newSession()
    own.conf.set(DROP_SHUFFLES, "true")
    blocks = own.read.schema(_BLOCK).parquet(*packed.inputFiles())

    most, least, seed = regressor.getMaxDepth(), regressor.getMinInstancesPerNode(), regressor.getSeed()
    trees = {t: Nodes(gains=[0.0] * len(cuts)) for t in range(regressor.getNumTrees())}
    for tree in trees.values():
        tree.add(0, n, most, piece_rows)
    while opened := sum(len(tree.open) for tree in trees.values()):
        sums = blocks.mapInArrow(_histograms(trees, spans, seed, mean), _SUMS)
        grouped = sums.repartition(min(opened, 8 * cores), "tree", "node").groupBy("tree", "node")
        for r in grouped.applyInArrow(_choose(spans, least, mean), _SPLIT).collect():
            tree, node = trees[r["tree"]], r["node"]
            tree.open.remove(node)
            tree.value[node] = r["value"]
            if r["feature"] >= 0:
                tree.feature[node], tree.cut[node], tree.left[node] = r["feature"], r["cut"], len(tree.left)
                tree.gains[r["feature"]] += r["gain"]
                for size in (r["n_left"], r["n_right"]):
                    tree.add(tree.depth[node] + 1, size, most, piece_rows)

    # The part of a tree above its pieces is a record of its own, with no node above it.
    tops = pa.concat_tables(
        _piece(t, -1, *tree.arrays(), np.array(tree.value), np.array(tree.gains)) for t, tree in trees.items()
    )
    staged = [stage(own.createDataFrame(tops.to_pylist(), _PIECE).coalesce(1), "trees")]
    with_pieces = [t for t, tree in trees.items() if tree.pieces]
    at_once = max(1, shuffled_rows // n)
    for i in range(0, len(with_pieces), at_once):
        some = {t: trees[t] for t in with_pieces[i : i + at_once]}
        n_pieces = sum(len(tree.pieces) for tree in some.values())
        parts = blocks.mapInArrow(_deal(some, len(cuts), seed), "tree int, node int, bins binary, y binary, w binary")
        grouped = parts.repartition(min(n_pieces, 64 * cores), "tree", "node").groupBy("tree", "node")
        grown = grouped.applyInArrow(_finish(some, spans, most, least), _PIECE)
        staged.append(stage(grown.repartition(min(n_pieces, cores)), "trees"))
    table = spark.read.schema(_PIECE).parquet(*(f for part in staged for f in part.inputFiles()))
    return DeepForest(table, cuts)._set(
        featuresCol=regressor.getFeaturesCol(), predictionCol=regressor.getPredictionCol()
    )


def assemble(records: list[dict]) -> list[tuple[np.ndarray, ...]]:
    """Whole trees from the records of their tops and pieces: feature, cut, left and value."""
    of_tree: dict[int, list[dict]] = {}
    for r in sorted(records, key=lambda r: (r["tree"], r["node"])):
        of_tree.setdefault(r["tree"], []).append(r)
    types = {"feature": np.uint8, "cut": np.uint8, "left": np.int32, "value": float}
    trees = []
    for parts in of_tree.values():
        arrays = [{n: np.frombuffer(p[n], t).copy() for n, t in types.items()} for p in parts]
        top, size = arrays[0], len(arrays[0]["left"])
        for part, own in zip(parts[1:], arrays[1:], strict=True):
            own["left"] += size
            size += len(own["left"])
            for name in types:
                top[name][part["node"]] = own[name][0]
            if own["cut"][0] == LEAF:
                top["left"][part["node"]] = part["node"]
        trees.append(tuple(np.concatenate([a[n] for a in arrays]) for n in types))
    return trees


class DeepForest(Transformer, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """The mean of deep trees. They are a staged table, which the driver and the workers hold as 14 bytes a node."""

    def __init__(self, table: DataFrame, cuts: list[list[float]]) -> None:
        super().__init__()
        self.table, self.cuts = table, cuts
        records = table.toArrow().to_pylist()
        self.trees = assemble(records)
        self.gains = np.zeros((len(self.trees), len(cuts)))
        for r in records:
            self.gains[r["tree"]] += r["gains"]
        self._shared: Broadcast | None = None

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the features in the gains: of each tree, then of all, as Spark ML has them."""
        totals = self.gains.sum(1, keepdims=True)
        shares = np.divide(self.gains, totals, out=np.zeros_like(self.gains), where=totals > 0).sum(0)
        return Vectors.dense(shares / shares.sum() if shares.sum() > 0 else shares)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._shared is None:
            self._shared = dataset.sparkSession.sparkContext.broadcast(self.trees)
        trees, cuts = self._shared, self.cuts

        @F.arrow_udf("double")
        def mean_of_trees(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in vectors:
                bins = binned(matrix(batch, len(cuts)), cuts)
                total, low, high = (np.full(bins.shape[1], start) for start in (0.0, np.inf, -np.inf))
                for *arrays, value in trees.value:
                    found = value[walk(bins, *arrays)]
                    total, low, high = total + found, np.minimum(low, found), np.maximum(high, found)
                # A mean lies among its parts, also where it is rounded.
                yield pa.array(np.clip(total / len(trees.value), low, high))

        scored = mean_of_trees(vector_to_array(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), scored)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: DeepForest) -> None:
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, {"cuts": self.forest.cuts})
        self.forest.table.write.parquet(os.path.join(path, "trees"))


class _Reader(MLReader):
    def load(self, path: str) -> DeepForest:
        spark: SparkSession = self.sparkSession
        known = DefaultParamsReader.loadMetadata(path, spark)
        table = spark.read.schema(_PIECE).parquet(os.path.join(path, "trees"))
        forest = DeepForest(table, known["cuts"])
        forest._resetUid(known["uid"])
        DefaultParamsReader.getAndSetParams(forest, known)
        return forest
