"""Boosting of many rows: binned rows stay in Spark's cache, and each level of a tree is one pass over them.

Spark ML keeps a row as objects of some 200 bytes, and walks all features of all rows on each level. Here a row is
a byte for each feature and what the trees have left of its target. Of two sibling nodes the one of fewer rows is
summed; the other is their parent without it. The loss on holdout rows is taken on the way, so that the rule
stops the rounds and nothing is fitted anew.

The trees are Spark ML's otherwise: at most ``maxBins`` bins of each feature, the split of the largest fall in
variance, the first tree on the targets, each later one on twice what is left, times the step size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .deep_forests import EQUAL, LEAF, TIE, best_splits, binned, feature_cuts, matrix, summed

# Rows from which boosting is done here. Spark ML fits fewer.
MANY_ROWS = 1_000_000
# Rows of a block, and of a partition that a task passes over.
BLOCK_ROWS = 131_072
PARTITION_ROWS = 2_000_000
# Trees that every pass takes off the targets before the rows are stored again without them.
PENDING = 5
# Partitions whose sums the driver adds up by itself.
FEW_PARTITIONS = 64
# Depth up to which the leaves of a tree have numbers of one byte.
DEEPEST = 7

_BLOCK = "bins binary, y binary, n int"


@dataclass(frozen=True)
class Tree:
    """A whole tree by levels. The children of node i are 2i + 1 and 2i + 2; a node without a split sends all left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return len(self.value).bit_length() - 1


def is_plain(regressor: GBTRegressor) -> bool:
    """Whether the regressor asks for nothing but what ``boost_rows`` does."""
    return (
        regressor.getMaxDepth() <= DEEPEST
        and regressor.getMaxBins() < LEAF
        and regressor.getLossType() == "squared"
        and regressor.getFeatureSubsetStrategy() == "all"
        and regressor.getSubsamplingRate() == 1.0
        and regressor.getMinInfoGain() == 0.0
        and regressor.getMinWeightFractionPerNode() == 0.0
        and not (regressor.isDefined(regressor.weightCol) and regressor.getWeightCol())
        and not regressor.isDefined(regressor.validationIndicatorCol)
        and not regressor.getLeafCol()
    )


def descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of a level at which each row is. All splits are looked at, by whole columns, and the row's picked."""
    ways: list[np.ndarray] = []
    at = np.zeros(bins.shape[1], np.uint8)
    for level in range(levels):
        first = 2**level - 1
        right = [bins[feature[i]] > cut[i] for i in range(first, 2 * first + 1)]
        for way in reversed(ways):
            right = [a ^ (way & (a ^ b)) for a, b in zip(right[::2], right[1::2], strict=True)]
        ways.append(right[0])
        at = 2 * at + right[0]
    return at


def _pack(cuts: Sequence[Sequence[float]], rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Binned rows in blocks, those to learn from first; ``n`` is their number."""

    def block(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, y, held = (np.concatenate(p, axis=-1) for p in zip(*parts, strict=True))
        order = np.argsort(held, kind="stable")
        row = {"bins": [bins[:, order].tobytes()], "y": [y[order].tobytes()], "n": pa.array([int((~held).sum())], pa.int32())}
        return pa.RecordBatch.from_pydict(row, pa.schema([("bins", pa.binary()), ("y", pa.binary()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held = batch["held"].to_numpy(zero_copy_only=False)
                parts.append((binned(matrix(batch["x"], len(cuts)), cuts), batch["y"].to_numpy(), held))
                size += batch.num_rows
            if size >= rows:
                yield block(parts)
                parts, size = [], 0
        if parts:
            yield block(parts)

    return run


Block = tuple[np.ndarray, np.ndarray, int]


def _left(block: Block, trees: Sequence[Tree]) -> Block:
    """A block with what the trees leave of its targets."""
    bins, y, n = block
    for tree in trees:
        y = y - tree.value[descend(bins, tree.feature, tree.cut, tree.depth)]
    return bins, y, n


def _level(
    trees: Sequence[Tree], feature: np.ndarray, cut: np.ndarray, level: int, wanted: Sequence[int], spans: list[int]
) -> Callable[[Iterator[Block]], Iterator[tuple]]:
    """Over the rows of a task: rows and summed targets by wanted node of a level and bin; sum and squares to learn, squares held out."""

    def run(blocks: Iterator[Block]) -> Iterator[tuple]:
        slot = np.full(2**level, -1)
        slot[list(wanted)] = np.arange(len(wanted))
        sums, squares = [np.zeros((2, len(wanted), span)) for span in spans], np.zeros(3)
        for block in blocks:
            bins, y, n = _left(block, trees)
            squares += y[:n].sum(), y[:n] @ y[:n], y[n:] @ y[n:]
            if wanted and n:
                at = slot[descend(bins[:, :n], feature, cut, level)]
                mine = np.flatnonzero(at >= 0) if level else None
                for total, found in zip(sums, summed(bins, at, (None, y), spans, len(wanted), mine), strict=True):
                    total += found
        yield sums, squares

    return run


def _added(a: tuple, b: tuple) -> tuple:
    return [x + y for x, y in zip(a[0], b[0], strict=True)], a[1] + b[1]


def _pass(rows: RDD, of_task: Callable[[Iterator[Block]], Iterator[tuple]]) -> tuple[list[np.ndarray], np.ndarray]:
    return rows.mapPartitions(of_task).treeReduce(_added, 1 if rows.getNumPartitions() <= FEW_PARTITIONS else 2)


def grow_tree(
    rows: RDD,
    pending: Sequence[Tree],
    root: tuple[int, float, float],
    sums: list[np.ndarray],
    spans: list[int],
    depth: int,
    least: int,
) -> tuple[Tree, np.ndarray]:
    """One tree on what the pending trees leave, from its root's rows, sum, squares and sums by bin; gains of the features."""
    feature, cut = np.zeros(2**depth - 1, np.uint8), np.full(2**depth - 1, LEAF, np.uint8)
    value, gains = np.zeros(2**depth), np.zeros(len(spans))
    n, total, squares = root
    # Nodes of a level, with their rows and summed targets; ``sums`` has them in this order.
    nodes = [(0, n, total)]
    for level in range(depth + 1):
        best, which, place = np.zeros(len(nodes)), np.zeros(len(nodes), int), np.zeros(len(nodes), int)
        if level < depth and nodes:
            for f, span in enumerate(spans):
                if span > 1:
                    found, gain = best_splits(*sums[f], least)
                    more = np.flatnonzero(gain > np.maximum(best * (1 + TIE), EQUAL * squares))
                    best[more], which[more], place[more] = gain[more], f, found[more]
        children, split = [], best > 0
        for k, (node, n_rows, target) in enumerate(nodes):
            if split[k]:
                i, f, p = 2**level - 1 + node, which[k], place[k]
                feature[i], cut[i] = f, p
                gains[f] += best[k]
                n_left, of_left = sums[f][:, k, : p + 1].sum(1)
                children += [(2 * node, n_left, of_left), (2 * node + 1, n_rows - n_left, target - of_left)]
            else:
                value[node << (depth - level)] = target / max(n_rows, 1)
        if not children:
            break
        if level + 1 < depth:
            small = np.arange(0, len(children), 2) + np.array([b[1] < a[1] for a, b in zip(children[::2], children[1::2])])
            of_task = _level(pending, feature, cut, level + 1, [children[c][0] for c in small], spans)
            own, _ = _pass(rows, of_task)
            parents, sums = sums, [np.zeros((2, len(children), span)) for span in spans]
            for both, few, whole in zip(parents, own, sums, strict=True):
                whole[:, small], whole[:, small ^ 1] = few, both[:, split] - few
        nodes = children
    return Tree(feature, cut, value), gains


def boost_rows(
    regressor: GBTRegressor,
    rows: DataFrame,
    held: Column,
    stop: Callable[[Sequence[float]], int | None],
    partitions: int | None = None,
) -> tuple[BoostedTrees, list[float]]:
    """The trees of all rounds up to the stop, and the holdout loss after each; none without holdout rows.

    ``rows`` are staged: they are read several times. ``stop`` says, from the losses, after which round to end.
    """
    label = F.col(regressor.getLabelCol()).cast("double")
    bad = F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))
    y = F.when(label.isNull() | F.isnan(label), bad).otherwise(label)
    known = rows.select(vector_to_array(regressor.getFeaturesCol()).alias("x"), y.alias("y"), held.alias("held"))
    n_all, n, mean = known.agg(F.count("*"), F.count_if(~F.col("held")), F.avg(F.when(~F.col("held"), F.col("y")))).first()
    if not n:
        raise ValueError("Boosting needs rows to learn from")
    cuts = feature_cuts(known.where("NOT held"), min(regressor.getMaxBins(), n))
    spans = [len(c) + 1 for c in cuts]
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = partitions or cores * -(-n_all // (cores * PARTITION_ROWS))
    centred = known.select("x", (F.col("y") - mean).alias("y"), "held")
    block_rows = max(1, min(BLOCK_ROWS, n_all // (4 * tasks)))
    packed = centred.mapInArrow(_pack(cuts, block_rows), _BLOCK).repartition(tasks)

    def unpacked(r: tuple) -> Block:
        return np.frombuffer(r["bins"], np.uint8).reshape(len(spans), -1), np.frombuffer(r["y"]), r["n"]

    blocks = packed.rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    most, depth, least, step = regressor.getMaxIter(), regressor.getMaxDepth(), regressor.getMinInstancesPerNode(), regressor.getStepSize()
    trees: list[Tree] = []
    gains: list[list[float]] = []
    losses: list[float] = []
    stored, without = blocks, 0
    none = np.zeros(0, np.uint8)
    try:
        while True:
            last = len(trees) == most
            if last and n == n_all:
                break
            pending = trees[without:]
            sums, (total, squares, lost) = _pass(stored, _level(pending, none, none, 0, [] if last else [0], spans))
            if trees and n < n_all:
                losses.append(float(lost / (n_all - n)))
            if last or stop(losses) is not None:
                break
            tree, more = grow_tree(stored, pending, (n, total, squares), sums, spans, depth, least)
            # Twice what is left is learnt, but for the first tree.
            trees.append(Tree(tree.feature, tree.cut, tree.value * (2 * step if trees else 1)))
            gains.append(more.tolist())
            if len(trees) - without >= PENDING + len(trees) // 40:
                if stored is not blocks:
                    stored.unpersist()
                done, without = list(trees), len(trees)
                stored = blocks.map(lambda block, done=done: _left(block, done)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        stored.unpersist()
        blocks.unpersist()
    first = trees[0]
    trees[0] = Tree(first.feature, first.cut, first.value + mean)
    model = BoostedTrees(cuts, trees, gains)._set(
        featuresCol=regressor.getFeaturesCol(), predictionCol=regressor.getPredictionCol()
    )
    return model, losses


class BoostedTrees(Transformer, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """The sum of the trees' values."""

    def __init__(self, cuts: list[list[float]], trees: list[Tree], gains: list[list[float]]) -> None:
        super().__init__()
        self.cuts, self.trees, self.gains = cuts, trees, gains

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the features in the gains of all trees, as Spark ML has them for boosting."""
        gains = np.sum(self.gains, 0)
        return Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)

    def cut_back(self, rounds: int) -> BoostedTrees:
        """The model of the first ``rounds`` trees."""
        return self._copyValues(BoostedTrees(self.cuts, self.trees[:rounds], self.gains[:rounds]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, cuts = self.trees, self.cuts

        @F.arrow_udf("double")
        def sum_of_trees(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in vectors:
                bins = binned(matrix(batch, len(cuts)), cuts)
                total = np.zeros(bins.shape[1])
                for tree in trees:
                    total += tree.value[descend(bins, tree.feature, tree.cut, tree.depth)]
                yield pa.array(total)

        return dataset.withColumn(self.getPredictionCol(), sum_of_trees(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedTrees) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        trees = [[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in self.model.trees]
        more = {"cuts": self.model.cuts, "trees": json.dumps(trees), "gains": self.model.gains}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, more)


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTrees:
        known = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees: Iterable = json.loads(known["trees"])
        arrays = [Tree(np.array(f, np.uint8), np.array(c, np.uint8), np.array(v, float)) for f, c, v in trees]
        model = BoostedTrees(known["cuts"], arrays, known["gains"])
        model._resetUid(known["uid"])
        DefaultParamsReader.getAndSetParams(model, known)
        return model
