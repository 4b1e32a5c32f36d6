"""Many small records as few rows: arrays of numbers packed by bucket.

Hashes of all words of a corpus as one row each would spend most of their time in row
handling. Here a task gathers the records of many texts, sorts them by bucket and gives one
row for each bucket with the records as bytes. Spark shuffles and groups these rows like any
others; a bucket's content is bounded by the number of buckets, which follows
``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

FLUSH_RECORDS = 1 << 21
PACKED = "bucket int, kind int, packed binary"
PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary())])


def bucket_count(spark: SparkSession, per_partition: int = 1) -> int:
    """Buckets for this session, for each shuffle partition as many as given.

    More of them are smaller and even out better. A task that sends records on has a row for
    each bucket it sends to, so that the product of two numbers of buckets in a row bounds the
    rows between them: it should stay a small multiple of the blocks of a shuffle.
    """
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each mixed hash, by its top 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


class Packer:
    """Gathers records and gives them packed, a row for each bucket.

    A row holds its records column by column: equal or close neighbours compress well.
    """

    def __init__(self, dtype: np.dtype, buckets: int, kind: int = 0) -> None:
        self.dtype, self.buckets, self.kind = np.dtype(dtype), buckets, kind
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, bucket: np.ndarray, *fields: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take records, and give the rows that are due."""
        columns = [f.astype(self.dtype[i], copy=False) for i, f in enumerate(fields)]
        self.waiting.append((bucket, *columns))
        self.size += len(bucket)
        if self.size >= FLUSH_RECORDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Give rows for all that was taken."""
        if not self.size:
            return
        bucket, *columns = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
        self.waiting, self.size = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket, columns = bucket[order], [c[order] for c in columns]
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        tails = np.append(heads[1:], len(bucket))
        packed = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(heads, tails, strict=True)]
        yield packed_rows(bucket[heads], self.kind, packed)


def packed_rows(bucket: np.ndarray, kind: int, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int32()),
            pa.array(np.full(len(bucket), kind), pa.int32()),
            pa.array(packed, pa.binary()),
        ],
        schema=PACKED_ARROW,
    )


def unpack(packed: pa.ChunkedArray | pa.Array, dtype: np.dtype) -> list[np.ndarray]:
    """The columns of all records in the given packed rows."""
    dtype = np.dtype(dtype)
    parts: list[list[np.ndarray]] = [[] for _ in dtype.names]
    for value in packed:
        content = value.as_buffer()
        n, at = len(content) // dtype.itemsize, 0
        for i, part in enumerate(parts):
            part.append(np.frombuffer(content, dtype=dtype[i], count=n, offset=at))
            at += n * dtype[i].itemsize
    return [np.concatenate(p) if p else np.zeros(0, dtype=dtype[i]) for i, p in enumerate(parts)]


def of_kind(table: pa.Table, kind: int) -> pa.ChunkedArray:
    """The packed bytes of the rows of one kind."""
    return table.filter(pc.equal(table["kind"], kind))["packed"]
