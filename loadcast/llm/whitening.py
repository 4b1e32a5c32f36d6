"""Whitening of embeddings by shifted CholeskyQR.

The distinct vectors, as integers, are the fit list. It is written once; every pass reads it
and never moves it.

1. One pass adds up the entries: the exact mean.
2. A Gram pass: each task centres its rows, carries them through the triangular solves so far
   (``Q = A R1^-1 R2^-1 ...``) and adds up ``Q'Q``; Spark adds the tasks' matrices row by row.
   The driver takes the Cholesky factor of the sum. The first is shifted, which keeps it
   definite however ill-conditioned the rows are; a later one is shifted only if it must be.
3. Passes go on until ``Q'Q`` is the identity to rounding. The composed factor
   ``R = ... R2 R1`` has the singular values of the centred rows, and its right singular
   vectors are the components: the covariance itself is never factorised, so small
   eigenvalues keep their precision.

The driver and every task hold matrices of ``dimension`` by ``dimension``, nothing that grows
with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.vectors import binary_rows, dimension, matrix, packed
from loadcast.session import stage

SCALE, LIMIT, INTEGER = 256, 2.0**53, "<i8"
MAX_DIMENSION = 4096
MAX_PASSES = 5
ORTHOGONAL = 1e-12
RANK = 1e-12
_PART = "i int, part binary"
_LARGEST = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What the passes give: sums of the fit list, its components and their eigenvalues.

    ``values`` has an eigenvalue for each component, falling; 0 where the fit list has no spread.
    """

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def factors(self) -> np.ndarray:
        """``dimension x components``: the centred row times it is the whitened row."""
        return self.components / np.sqrt(np.where(self.values > 0, self.values, np.nan))


def solve_upper(factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``rows @ inverse(factor)`` for an upper triangular factor, by forward substitution over its columns."""
    out = np.array(rows, dtype=np.float64)
    width = 32
    for a in range(0, factor.shape[0], width):
        b = min(a + width, factor.shape[0])
        out[:, a:b] -= out[:, :a] @ factor[:a, a:b]
        for j in range(a, b):
            out[:, j] -= out[:, a:j] @ factor[a:j, j]
            out[:, j] /= factor[j, j]
    return out


def _entry_sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = [0] * width, 0
        for batch in batches:
            x = matrix(batch.column(0), INTEGER, width)
            # Halves of 32 bits: no sum of a batch leaves 64 bits.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low, strict=True)]
            rows += len(x)
        # An entry beyond 64 bits cannot be given as a long: as two halves.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(width), pa.int32()),
                pa.array([t >> 32 for t in total], pa.int64()),
                pa.array([t & 0xFFFFFFFF for t in total], pa.int64()),
                pa.array([rows] * width, pa.int64()),
            ],
            names=["i", "high", "low", "n"],
        )

    return run


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """How many rows there are, and the exact sum of each entry."""
    parts = fit.mapInArrow(_entry_sums(width), "i int, high long, low long, n long").groupBy("i")
    rows = parts.agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n"))).collect()
    sums = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows}
    return (int(rows[0]["n"]) if rows else 0), [sums.get(i, 0) for i in range(width)]


def _add_parts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p.as_buffer(), dtype="<f8") for p in table["part"])
    return pa.table({"i": table["i"][:1], "part": binary_rows(np.atleast_2d(total))}, pa.schema([("i", pa.int32()), ("part", pa.binary())]))


def _gram(fit: DataFrame, width: int, image, size: int) -> np.ndarray:
    """The sum over all rows of ``y'y``, where ``image`` makes the rows ``y`` of a block of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = image(matrix(batch.column(0), INTEGER, width))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), binary_rows(total)], names=["i", "part"])

    rows = fit.mapInArrow(run, _PART).groupBy("i").applyInArrow(_add_parts, _PART).collect()
    out = np.zeros((size, size))
    for row in rows:
        out[row["i"]] = np.frombuffer(bytes(row["part"]), dtype="<f8")
    return (out + out.T) / 2


def _shift(gram: np.ndarray, n: int) -> float:
    """The shift that makes the factor exist for any rows: 11 (n d + d (d + 1)) u |A|^2."""
    d = len(gram)
    unit = np.finfo(np.float64).eps / 2
    return max(11 * (n * d + d * (d + 1)) * unit * float(np.linalg.norm(gram, 2)), np.finfo(np.float64).tiny)


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper triangular factor of a Gram matrix; with a shift where asked or where it takes one."""
    if not shifted:
        try:
            factor = np.linalg.cholesky(gram).T
            if np.diag(factor).min() > np.sqrt(_shift(gram, n)):
                return factor
        except np.linalg.LinAlgError:
            pass
    shift = _shift(gram, n)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift *= 100


def fit_whitening(rows: DataFrame, vector_column: str, components: int) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows``; None if there are no usable vectors."""
    width = dimension(rows, vector_column)
    if width > MAX_DIMENSION:
        raise ValueError(f"vectors of {width} entries; the most that fit one matrix are {MAX_DIMENSION}")
    if not width:
        return None
    # Equal vectors collapse before the shuffle, too: a hot one is one row for each task.
    fit = stage(packed(rows, [], vector_column, SCALE, LIMIT, INTEGER, width).distinct(), "fit-list")
    n, sums = _sums(fit, width)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray) -> np.ndarray:
        return reduce(lambda y, r: solve_upper(r, y), factors, x - mean)

    trace, gram = 0.0, np.zeros((width, width))
    for turn in range(MAX_PASSES):
        gram = _gram(fit, width, orthogonalised, width)
        if turn == 0:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                break
        elif np.abs(gram - np.eye(width)).max() <= ORTHOGONAL * np.sqrt(width):
            break
        factors.append(_factor(gram, n, shifted=turn == 0))
    composed = reduce(lambda total, r: r @ total, factors, np.eye(width))
    _, singular, right = np.linalg.svd(composed)
    if trace == 0:
        singular = np.zeros(width)
    values = np.where(singular > RANK * singular.max(), singular**2 / n, 0.0)[:components]
    chosen = right[:components].T
    top = np.abs(chosen).argmax(axis=0)
    chosen = chosen * np.sign(chosen[top, range(chosen.shape[1])])
    spread = values > 0
    columns = chosen[:, spread] / np.sqrt(values[spread])
    k = columns.shape[1]
    both = _gram(fit, width, lambda x: np.column_stack([(x - mean) @ columns, np.ones(len(x))]), k + 1) / n
    covariance = both[:k, :k] - np.outer(both[k, :k], both[k, :k])
    error = float(np.abs(covariance - np.eye(k)).max()) if k else 0.0
    return Whitening(n, sums, chosen, values, trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sums of ``(n x - S)^2``; None for one that is no long."""
    largest = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if largest * largest * len(sums) <= _LARGEST:
        off = n * x - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = x.astype(object) * n - np.array(sums, dtype=object)
    return [v if v <= _LARGEST else None for v in (off * off).sum(axis=1).tolist()]


_WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 4
) -> DataFrame:
    """``id_column``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    A row for each usable row of ``rows``, repeated ones and those without an id too, and each
    component up to ``components``. Left out are rows whose vector is null, empty, of another
    length than most, or has an entry that is null, not finite or of 2^45 or more. Entries count
    as ``floor(256 * entry)``. The components and their eigenvalues are over the distinct vectors.
    ``whitened`` is null for a component without spread (fewer distinct vectors than components,
    constant entries), ``explained`` is then 0; ``deviation`` is null where it is no long. Of
    components with one eigenvalue any basis may be given; the largest entry of each is positive.
    Other columns are not read. An empty table gives an empty result.
    """
    model = fit_whitening(rows, vector_column, components)
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {_WHITENED}"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    width, k = model.components.shape
    mean, factors = model.mean, model.factors()
    explained = model.values / model.trace if model.trace else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), INTEGER, width)
            of = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(of), model.n, dtype=np.int64)),
                    deviation.take(pa.array(of)),
                    pa.array(((x - mean) @ factors).reshape(-1), from_pandas=True),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(of), model.identity_error)),
                ],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return packed(rows, [id_column], vector_column, SCALE, LIMIT, INTEGER, width).mapInArrow(run, schema)
