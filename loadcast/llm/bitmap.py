"""A set of 64-bit values as a bitmap of bounded size, for leaving out what cannot match.

A bitmap never says no to a value it holds; it may say yes to others, which then cost time
in an exact step but change no result. It is the only data the operators ship to every
task, and its size has an upper bound: past ``MAX_BITS`` it says yes more often, and the
exact step does more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
_BUCKET_BITS = 32768


class Bitmap:
    """Membership by the top bits of well mixed values."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.shift = np.uint64(64 - int(np.log2(len(bits) * 8)))

    def __contains__(self, values: np.ndarray) -> bool:
        return bool(self.has(np.atleast_1d(values)).any())

    def has(self, values: np.ndarray) -> np.ndarray:
        place = values.view(np.uint64) >> self.shift
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits_for(count: int) -> int:
    """A power of two with 16 bits or more for each value, within the bounds."""
    bits = MIN_BITS
    while bits < min(16 * count, MAX_BITS):
        bits *= 2
    return bits


def collect_bitmap(values: DataFrame, column: str, count: int) -> Bitmap:
    """The bitmap of a column of hashes (long). ``count`` is about how many there are.

    Spark builds it in pieces of 32768 bits; the driver gets ``bits / 8`` bytes at most.
    """
    bits = bits_for(count)
    shift = 64 - bits.bit_length() + 1
    place = F.shiftrightunsigned(F.col(column), shift) + F.lit(1)
    pieces = (
        values.where(F.col(column).isNotNull())
        .groupBy(F.bitmap_bucket_number(place).alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for piece, content in pieces.toLocalIterator():
        at = (piece - 1) * (_BUCKET_BITS // 8)
        part = np.frombuffer(bytes(content), dtype=np.uint8)
        out[at : at + len(part)] = part
    return Bitmap(out)
