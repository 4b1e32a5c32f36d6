"""Vectors of numbers as packed integers: the form in which the vector operators read them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(rows: DataFrame, column: str) -> int:
    """The most common length of the vectors, the longer one of equally common; 0 without any."""
    lengths = rows.select(F.size(column).alias("d")).where("d > 0").groupBy("d").count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return most["d"] if most else 0


def binary_rows(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize * values.shape[1]
    offsets = np.arange(len(values) + 1, dtype=np.int64) * width
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.large_binary(), len(values), buffers).cast(pa.binary())


def matrix(packed: pa.Array, dtype: str, width: int) -> np.ndarray:
    """The matrix whose rows are the given bytes."""
    if not len(packed):
        return np.zeros((0, width), dtype=dtype)
    _, offsets, data = packed.cast(pa.large_binary()).buffers()
    first = np.frombuffer(offsets, dtype=np.int64)[packed.offset]
    return np.frombuffer(data, dtype=dtype, count=len(packed) * width, offset=first).reshape(-1, width)


def _packing(scale: int, limit: float, dtype: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0)
            batch = batch.filter(pc.equal(lengths, width))
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            scaled = np.floor(flat.astype(np.float64).reshape(-1, width) * scale)
            # False for what is not a number, too.
            good = (np.abs(scaled) < limit).all(axis=1)
            batch = batch.filter(pa.array(good))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "x"]
            yield pa.RecordBatch.from_arrays([*columns, binary_rows(scaled[good].astype(dtype))], names=names)

    return run


def packed(
    rows: DataFrame, columns: list[str], vector_column: str, scale: int, limit: float, dtype: str, width: int
) -> DataFrame:
    """``columns`` and ``x``, the bytes of ``floor(scale * entry)``, of every row with a usable vector.

    A vector that is null, has a length other than ``width``, or an entry that is null, not
    finite or not below ``limit`` once scaled is left out with its row.
    """
    chosen = rows.select(*columns, F.col(vector_column).cast("array<double>").alias("x"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(_packing(scale, limit, dtype, width), ", ".join([*fields, "x binary"]))
