"""Toxicity by a small convolutional network, trained in numpy and applied inside Spark tasks.

A word's embedding is the sum of rows of one table: those at the hashes of the word and of its
first four to seven bytes, so that an unseen compound shares what its start has learnt. Filters over one, two and three words slide along the text; each filter's largest value
anywhere in the text goes to a logistic layer.

Every labelled row that is not held out is learnt from, with its whole text. Rows are dealt by
their hash into shards; in a round each shard's task goes through its rows in small steps from
the common network, and the shards' networks are averaged. A quarter of the ids is held back from
that and gives the cuts, all of their rows counted.

The score is a probability whose scale is shifted so that ``DECISION`` is the best cut on the held
back rows. Beside it, each language has a cut of its own from the same rows: the
language chooses the cut only and is never an input of the score.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bitmap import Bitmap, collect_bitmap
from loadcast.llm.words import Words, alphanumeric, mix, split_words

DECISION = 0.3
BUCKETS = 1 << 15
STARTS = (4, 5, 6, 7)
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
# Rounds over all rows: the most, the fewest, and how many rows are to be visited in between.
EPOCHS = 8
MIN_EPOCHS = 2
VISITS = 32_000
# A shard's rows pass through one task a round; beyond the most shards they grow, streamed.
SHARD_ROWS = 32_768
MAX_SHARDS = 64
# The table is averaged in blocks of so many rows.
BLOCK_ROWS = 4096
# Cuts are found on logits in steps of 1 / CUT_STEPS.
CUT_STEPS = 256
BATCH_TEXTS = 64
LEARNING_RATE = 0.01
CALIBRATION_SHARE = 0.25
MIN_LANGUAGE_ROWS = 40
SEED = 20240


@dataclass
class Model:
    """Weights of the network, the shift of its logit, and the cut of each language."""

    table: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    constant: float
    shift: float
    cuts: dict[str, float]


def word_rows(part: Words) -> np.ndarray:
    """Rows of the embedding table for each word: its own, and one for each of its starts.

    A start counts only for words that are longer: a stem alone and a compound of it differ.
    """
    mask = np.uint64(BUCKETS - 1)
    length = part.ends - part.starts
    rows = np.full((len(length), 1 + len(STARTS)), BUCKETS, dtype=np.int32)
    rows[:, 0] = part.hashes & mask
    packed = np.zeros(len(length), dtype=np.uint64)
    fold = alphanumeric().fold
    for size in range(1, max(STARTS) + 1):
        letter = fold[part.data[np.minimum(part.starts + size - 1, len(part.data) - 1)]]
        packed = (packed << np.uint64(8)) | letter.astype(np.uint64)
        if size in STARTS:
            longer = length > size
            rows[longer, STARTS.index(size) + 1] = mix(packed[longer] ^ (np.uint64(size) << np.uint64(56))) & mask
    return rows


def padded(part: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the words with padding after each text, and where each text begins.

    The padding is as long as the widest filter, so that every filter has a place in every text,
    also in one without words; its row is the last of the table and stays zero.
    """
    room = max(WIDTHS)
    bounds = part.bounds + np.arange(part.count + 1) * room
    rows = np.full((int(bounds[-1]), 1 + len(STARTS)), BUCKETS, dtype=np.int32)
    rows[np.arange(len(part.starts)) + part.text * room] = word_rows(part)
    return rows, bounds


def embedded(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of each word's rows."""
    x = table[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        x += table[rows[:, k]]
    return x


def _responses(x: np.ndarray, filters: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Every filter's value at every word: ``filters`` has a matrix for each place of each width.

    Texts end before ``ends``; where a filter would reach into the next text it has no value.
    """
    flat = x @ filters
    out = np.empty((len(x), len(WIDTHS) * FILTERS), dtype=np.float32)
    at = 0
    for w, width in enumerate(WIDTHS):
        total = flat[:, at : at + FILTERS].copy()
        for k in range(1, width):
            block = flat[:, at + k * FILTERS : at + (k + 1) * FILTERS]
            total[:-k] += block[k:]
        for k in range(1, width):
            total[ends - k] = -np.inf
        out[:, w * FILTERS : (w + 1) * FILTERS] = total
        at += width * FILTERS
    return out


def logits(model: Model, part: Words) -> np.ndarray:
    """The network's output for each text of a slice."""
    rows, bounds = padded(part)
    if not part.count:
        return np.zeros(0)
    x = embedded(model.table, rows)
    pooled = np.maximum.reduceat(_responses(x, model.filters, bounds[1:]), bounds[:-1], axis=0)
    return np.maximum(pooled + model.bias, 0) @ model.dense + model.constant


def _parts(texts: pd.Series) -> list[tuple[np.ndarray, np.ndarray]]:
    """Padded word rows of each text of a sample."""
    out = []
    for part in split_words(pa.array(texts, pa.string()), alphanumeric()):
        rows, bounds = padded(part)
        out += [rows[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


class _Adam:
    def __init__(self, shape: tuple[int, ...]) -> None:
        self.m, self.v, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        return LEARNING_RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


class _Training:
    """A network on its way: its weights and what the steps remember."""

    def __init__(self, random: np.random.Generator) -> None:
        places = sum(WIDTHS) * FILTERS
        self.model = Model(
            table=(random.standard_normal((BUCKETS + 1, DIMENSIONS)) * 0.02).astype(np.float32),
            filters=(random.standard_normal((DIMENSIONS, places)) * 0.3).astype(np.float32),
            bias=np.zeros(len(WIDTHS) * FILTERS, np.float32),
            dense=(random.standard_normal(len(WIDTHS) * FILTERS) * 0.3).astype(np.float32),
            constant=0.0,
            shift=0.0,
            cuts={},
        )
        self.model.table[BUCKETS] = 0
        # The table's rows are stepped only when they are touched, with their own scale (AdaGrad).
        self.seen = np.full((BUCKETS + 1, 1), 1e-6, np.float32)
        self.adam = {k: _Adam(getattr(self.model, k).shape) for k in ("filters", "bias", "dense")}
        self.last = _Adam(())

    def step(self, rows: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> None:
        """One step on a batch: the padded word rows of its texts, which lie between ``bounds``."""
        model, adam = self.model, self.adam
        heads, ends = bounds[:-1], bounds[1:]
        x = embedded(model.table, rows)
        out = _responses(x, model.filters, ends)
        pooled = np.maximum.reduceat(out, heads, axis=0) + model.bias
        active = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-(active @ model.dense + model.constant)))
        error = ((p - labels) / len(labels)).astype(np.float32)
        back = error[:, None] * model.dense[None, :] * (pooled > 0)
        g_filters, g_rows, g_values = np.zeros_like(model.filters), [], []
        best = np.stack([out[a:b].argmax(axis=0) + a for a, b in zip(heads, ends, strict=True)])
        at = 0
        for w, width in enumerate(WIDTHS):
            mine = slice(w * FILTERS, (w + 1) * FILTERS)
            g = back[:, mine]
            for k in range(width):
                place = np.minimum(best[:, mine] + k, len(rows) - 1)
                taken = x[place]  # texts, filters, dimensions
                columns = slice(at + k * FILTERS, at + (k + 1) * FILTERS)
                g_filters[:, columns] = np.einsum("tfd,tf->df", taken, g)
                g_rows.append(rows[place].reshape(-1, 1 + len(STARTS)))
                g_values.append((g[:, :, None] * model.filters[:, columns].T[None]).reshape(-1, DIMENSIONS))
            at += width * FILTERS
        touched, values = np.concatenate(g_rows), np.concatenate(g_values)
        index, inverse = np.unique(touched, return_inverse=True)
        total = np.zeros((len(index), DIMENSIONS), np.float32)
        np.add.at(total, inverse.reshape(touched.shape), values[:, None, :])
        total += 1e-5 * model.table[index]
        self.seen[index, 0] += (total * total).mean(axis=1)
        model.table[index] -= 0.05 * total / np.sqrt(self.seen[index])
        model.table[BUCKETS] = 0
        model.filters -= adam["filters"].step(g_filters)
        model.bias -= adam["bias"].step(back.sum(axis=0))
        model.dense -= adam["dense"].step(active.T @ error + 1e-4 * model.dense)
        model.constant -= float(self.last.step(np.float32(error.sum())))

    def blocks(self) -> list[np.ndarray]:
        """All numbers: the table with its scales in blocks of rows, then the others in one array."""
        rows = np.hstack([self.model.table, self.seen])
        steps = [*self.adam.values(), self.last]
        rest = [self.model.filters, self.model.bias, self.model.dense, *(v for a in steps for v in (a.m, a.v))]
        numbers = [self.model.constant, *(a.t for a in steps)]
        flat = np.concatenate([*(np.ravel(v) for v in rest), numbers]).astype(np.float64)
        return [*(rows[i : i + BLOCK_ROWS] for i in range(0, len(rows), BLOCK_ROWS)), flat]

    def put(self, blocks: list[np.ndarray]) -> None:
        """Take over what ``blocks`` gave."""
        rows, flat, model = np.vstack(blocks[:-1]), blocks[-1], self.model
        model.table, self.seen = rows[:, :DIMENSIONS].copy(), rows[:, DIMENSIONS:].copy()
        steps = [*self.adam.values(), self.last]
        at = 0
        for owner, name in [*((model, k) for k in self.adam), *((a, k) for a in steps for k in ("m", "v"))]:
            old = getattr(owner, name)
            setattr(owner, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        model.constant = float(flat[at])
        for k, a in enumerate(steps, 1):
            a.t = float(flat[at + k])


def _train(texts: list[np.ndarray], labels: np.ndarray) -> Model:
    random = np.random.default_rng(SEED)
    training = _Training(random)
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for first in range(0, len(order), BATCH_TEXTS):
            chosen = order[first : first + BATCH_TEXTS]
            rows = np.concatenate([texts[i] for i in chosen])
            training.step(rows, np.cumsum([0, *(len(texts[i]) for i in chosen)]), labels[chosen])
    return training.model


def _perhaps_labelled(shared):
    """The rows whose id may have a label, so that other texts take no part in the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Bitmap = shared.value
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(known.has(key)))

    return run


def _round(shared):
    """Each shard's way through its rows from the common network; its numbers come out in blocks.

    The rows of a shard follow each other in one partition. That one usually has no other shard, but
    the shard is told by its number: how many partitions there are does not change what is learnt.
    """

    def numbers(shard: int, training: _Training) -> pa.RecordBatch:
        blocks = [v.tobytes() for v in training.blocks()]
        columns = [pa.array(range(len(blocks)), pa.int32()), pa.array([shard] * len(blocks), pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.binary())], names=["block", "shard", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        training, current = None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(shards) else []
            for head, end in zip(heads, [*heads[1:], len(shards)], strict=True):
                if shards[head] != current:
                    if training:
                        yield numbers(current, training)
                    training, current = copy.deepcopy(shared.value), int(shards[head])
                own = batch.slice(head, end - head)
                labels = own.column("toxic").to_numpy(zero_copy_only=False).astype(np.float32)
                for part in split_words(own.column("text"), alphanumeric()):
                    rows, bounds = padded(part)
                    for a in range(0, part.count, BATCH_TEXTS):
                        b = min(a + BATCH_TEXTS, part.count)
                        marks = labels[part.first + a : part.first + b]
                        training.step(rows[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], marks)
        if training:
            yield numbers(current, training)

    return run


def _average(shared):
    """One block of the common network: a table row is moved by the mean of the shards that moved it."""

    def run(found: pd.DataFrame) -> pd.DataFrame:
        block = int(found["block"].iloc[0])
        base = shared.value.blocks()[block]
        moved = [np.frombuffer(v, base.dtype).reshape(base.shape) - base for v in found.sort_values("shard")["numbers"]]
        if base.ndim == 1:
            total = base + sum(moved) / len(moved)
        else:
            touched = sum((m != 0).any(axis=1, keepdims=True).astype(base.dtype) for m in moved)
            total = base + sum(moved) / np.maximum(touched, 1)
        return pd.DataFrame({"block": [block], "numbers": [total.astype(base.dtype).tobytes()]})

    return run


def _judge(shared):
    """The logit of each held back row, in steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [np.zeros(0), *(logits(shared.value, part) for part in split_words(batch.column("text"), alphanumeric()))]
            step = np.round(np.clip(np.concatenate(z), -30, 30) * CUT_STEPS)
            rest = [batch.column(c) for c in ("lang", "toxic")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(step, pa.int32())], names=["lang", "toxic", "step"])

    return run


def _cut_of(counted: pd.DataFrame) -> float:
    """The best cut of rows counted by ``step`` and ``toxic``."""
    z, y = counted["step"].to_numpy(np.float64) / CUT_STEPS, counted["toxic"].to_numpy(np.float64)
    return _best_cut(z, y, counted["rows"].to_numpy(np.float64))


def _language_cut(counted: pd.DataFrame) -> pd.DataFrame:
    """One language's cut, if it has enough rows and both classes."""
    enough = counted["rows"].sum() >= MIN_LANGUAGE_ROWS and counted["toxic"].nunique() == 2
    return pd.DataFrame({"lang": counted["lang"].iloc[:1], "cut": [_cut_of(counted)]}).iloc[: int(enough)]


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def _best_cut(z: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the widest gap among cuts with the best F1 of the weighted rows."""
    order = np.argsort(-z, kind="stable")
    z, y, w = z[order], labels[order], weights[order]
    hits, taken = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hits / (taken + (w * y).sum())
    below = np.append(z[1:], z[-1] - 1.0)
    f1[z == below] = -1
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    best = top[np.argmax(z[top] - below[top])]
    return float((z[best] + below[best]) / 2)


def fit(sample: pd.DataFrame, positive_share: float) -> Model:
    """Train in one process on rows with ``text, toxic, lang``; both classes must be there.

    ``positive_share`` is the share of toxic rows among all labelled rows: rows that have
    another are weighted back for the cuts. Tables are learnt from by ``learn``.
    """
    sample = sample.reset_index(drop=True)
    texts, labels = _parts(sample["text"]), sample["toxic"].to_numpy(np.float32)
    held = np.random.default_rng(SEED + 1).random(len(sample)) < CALIBRATION_SHARE
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held = np.zeros(len(sample), dtype=bool)
    train = np.flatnonzero(~held)
    model = _train([texts[i] for i in train], labels[train])
    judged = sample[held] if held.any() else sample
    z = np.concatenate(
        [logits(model, part) for part in split_words(pa.array(judged["text"], pa.string()), alphanumeric())]
    )
    y = judged["toxic"].to_numpy(np.float64)
    weights = np.where(y > 0, positive_share / max(y.mean(), 1e-9), (1 - positive_share) / max(1 - y.mean(), 1e-9))
    model.shift = _logit(DECISION) - _best_cut(z, y, weights)
    for lang, group in judged.reset_index(drop=True).groupby("lang"):
        own = y[group.index]
        if len(group) >= MIN_LANGUAGE_ROWS and 0 < own.sum() < len(own):
            cut = _best_cut(z[group.index], own, weights[group.index]) + model.shift
            model.cuts[str(lang)] = float(1 / (1 + np.exp(-cut)))
    return model


def held_out(id_column: str) -> Column:
    """Whether the id, as text, has a crc32 of 2 modulo 4: never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def epochs_of(rows: int) -> int:
    """How often all rows are gone through: small tables more often."""
    return max(MIN_EPOCHS, min(EPOCHS, -(-VISITS // max(rows, 1))))


def learn(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, lang_column: str) -> tuple[Model | None, float]:
    """The network learnt from every labelled row that is not held out, and the share of toxic ids.

    An id with contradicting labels is toxic. Every text of a repeated id is learnt from. Without
    rows of both classes there is no network.
    """
    context = docs.sparkSession.sparkContext
    usable = labels.where(F.col(id_column).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_column))
    marked = usable.groupBy(F.col(id_column).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = marked.agg(F.count(F.lit(1)).alias("ids"), F.avg(F.col("toxic").cast("double")).alias("share")).first()
    share = known["share"] or 0.0
    if share in (0.0, 1.0):
        return None, share
    texts = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(text_column, F.lit("")).alias("text"),
        (F.col(lang_column) if lang_column in docs.columns else F.lit(None)).cast("string").alias("lang"),
    )
    if texts.schema["id"].dataType == marked.schema["id"].dataType:
        shared = context.broadcast(collect_bitmap(marked.select(F.xxhash64("id").alias("key")), "key", known["ids"]))
        keyed = texts.where(F.col("id").isNotNull()).withColumn("key", F.xxhash64("id"))
        texts = keyed.mapInArrow(_perhaps_labelled(shared), keyed.schema).drop("key")
    # Shard and order follow from the row itself, whatever the partitioning. Every shard writes a whole
    # network in each round, so their number is that of the rows and not that of the partitions.
    order = F.xxhash64("id", "text", F.lit(SEED))
    shards = min(MAX_SHARDS, -(-known["ids"] // SHARD_ROWS))
    rows = (
        # Labels grow with the documents: neither side is broadcast, at any size.
        texts.join(marked.hint("merge"), "id")
        .withColumns({"back": F.pmod(F.xxhash64("id"), F.lit(1000)) < int(1000 * CALIBRATION_SHARE), "order": order})
        .withColumn("shard", F.pmod(F.hash("order"), F.lit(shards)))
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "order", "id", "text", "lang")
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        counts = {(r["back"], r["toxic"]): r["count"] for r in rows.groupBy("back", "toxic").count().collect()}
        if len({toxic for _, toxic in counts}) < 2:
            return None, share
        train = judged = rows
        if len(counts) == 4:
            train, judged = rows.where(~F.col("back")), rows.where("back")
        training = _Training(np.random.default_rng(SEED))
        used = sum(n for (back, _), n in counts.items() if len(counts) < 4 or not back)
        for _ in range(epochs_of(used)):
            shared = context.broadcast(training)
            parts = train.select("shard", "text", "toxic").mapInArrow(_round(shared), "block int, shard int, numbers binary")
            merged = parts.groupBy("block").applyInPandas(_average(shared), "block int, numbers binary").collect()
            found, old = {r["block"]: r["numbers"] for r in merged}, training.blocks()
            training.put([np.frombuffer(found[k], v.dtype).reshape(v.shape) for k, v in enumerate(old)])
            shared.destroy()
        model = training.model
        steps = judged.select("text", "lang", "toxic").mapInArrow(
            _judge(context.broadcast(model)), "lang string, toxic int, step int"
        )
        counted = steps.groupBy("lang", "toxic", "step").agg(F.count(F.lit(1)).alias("rows")).persist()
        total = counted.groupBy("toxic", "step").agg(F.sum("rows").alias("rows")).toPandas()
        model.shift = _logit(DECISION) - _cut_of(total)
        cuts = counted.where(F.col("lang").isNotNull()).groupBy("lang").applyInPandas(_language_cut, "lang string, cut double")
        for lang, cut in cuts.orderBy("lang").collect():
            model.cuts[lang] = float(1 / (1 + np.exp(-(cut + model.shift))))
        counted.unpersist()
    finally:
        rows.unpersist()
    return model, share


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    """A score for each text; 0 for a text without words."""
    out = [np.zeros(0)]
    for part in split_words(texts, alphanumeric()):
        z = np.clip(logits(model, part) + model.shift, -30, 30)
        out.append(np.where(part.lengths > 0, 1 / (1 + np.exp(-z)), 0.0))
    return np.concatenate(out)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(c) for c in ("id", "held_out", "lang")]
            score = pa.array(_scores(shared.value, batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*rest, score], names=["id", "held_out", "lang", "score"])

    return run


def _keep(shared, text: int, lang: int | None):
    """The rows of a batch below the cut of their language, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            names = batch.column(lang).to_pylist() if lang is not None else [None] * len(batch)
            cuts = np.array([model.cuts.get(str(name), DECISION) for name in names])
            yield batch.filter(pa.array(_scores(model, batch.column(text)) < cuts))

    return run


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` does not reject, with all their columns.

    Without labels of both classes every row stays.
    """
    model, _ = learn(docs, labels, id_column, text_column, lang_column)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = {name: i for i, name in enumerate(docs.columns)}
    return docs.mapInArrow(_keep(shared, at[text_column], at.get(lang_column)), docs.schema)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: ``id_column, held_out, score, predicted, cut, rejected``.

    ``labels`` has ``id_column`` and ``toxic`` (0 or 1); rows held out by their id are not learnt
    from. ``predicted`` is 1 from a score of ``DECISION``; ``rejected`` is by the cut of the row's
    language, which is ``DECISION`` where too few held back rows have it. A null, empty or
    wordless text scores 0. Without labels of both classes every score is the share
    of toxic labels. Rows without an id and repeated rows are scored like others. Extra columns
    are not read.
    """
    spark = docs.sparkSession
    model, share = learn(docs, labels, id_column, text_column, lang_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        held_out(id_column).alias("held_out"),
        F.col(text_column).alias("text"),
        (F.col(lang_column) if lang_column in docs.columns else F.lit(None)).cast("string").alias("lang"),
    )
    cut = F.lit(DECISION)
    if model is None:
        scored = rows.select("id", "held_out", "lang", F.lit(float(share)).alias("score"))
    else:
        shared = spark.sparkContext.broadcast(model)
        scored = rows.mapInArrow(_score(shared), "id long, held_out boolean, lang string, score double")
        for lang, value in model.cuts.items():
            cut = F.when(F.col("lang") == lang, F.lit(value)).otherwise(cut)
    return scored.select(
        F.col("id").alias(id_column),
        "held_out",
        "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"),
        cut.alias("cut"),
        (F.col("score") >= cut).alias("rejected"),
    )
