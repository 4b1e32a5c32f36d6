"""Words of many texts at once, as numpy arrays, inside one task.

A batch of texts is cut into slices of about a megabyte. In a slice every byte is looked
at by whole-array operations: there is no Python loop over words. A longer text is a slice
of its own, so memory follows the longest text, not the batch.

Hashes have 64 bits and are the same on every machine. A word's hash is a polynomial over
its bytes, then mixed; a sequence's is a combination of its words' hashes, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEQUENCE = np.uint64(0xD1342543DE82EF95)
_SEQUENCE_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64, inverse: np.uint64) -> None:
        self.base, self.inverse = base, inverse
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES)
            for name, base in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(_MULTIPLIER, _INVERSE)
_WORD_POWERS = _Powers(_SEQUENCE, _SEQUENCE_INVERSE)


@dataclass(frozen=True)
class Alphabet:
    """Which bytes are part of a word, and what each byte is read as."""

    in_word: np.ndarray
    fold: np.ndarray


def _folded() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def spaced(fold_case: bool) -> Alphabet:
    r"""Words between the bytes ``\x20`` and ``\x09`` to ``\x0D``; A-Z read as a-z if asked."""
    in_word = np.ones(256, dtype=bool)
    in_word[[0x20, *range(0x09, 0x0E)]] = False
    return Alphabet(in_word, _folded() if fold_case else np.arange(256, dtype=np.uint8))


def alphanumeric() -> Alphabet:
    """Words of ASCII digits, ASCII letters (A-Z read as a-z) and everything beyond ASCII."""
    in_word = np.zeros(256, dtype=bool)
    in_word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return Alphabet(in_word, _folded())


@dataclass
class Words:
    """The words of the texts ``first`` to ``first + count`` of a batch."""

    first: int
    count: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        """Words of each text of the slice."""
        return np.diff(self.bounds)

    def places(self) -> np.ndarray:
        """The place of each word in its own text."""
        return np.arange(len(self.starts)) - self.bounds[self.text]

    def sequences(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Word index and hash of every run of ``size`` words inside one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return at, self.sequence_hashes(at, size)

    def sequence_hashes(self, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Hashes of the runs that begin at the word indices ``at``."""
        up, down = _WORD_POWERS.upto(len(self.hashes) + 1)
        total = np.zeros(len(self.hashes) + 1, dtype=np.uint64)
        np.cumsum(self.hashes * up[:-1], out=total[1:])
        return mix((total[at + size] - total[at]) * down[at])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of each shingle; a text of fewer words is one shingle."""
        at, hashes = self.sequences(size)
        lengths = self.lengths
        short = np.flatnonzero((lengths > 0) & (lengths < size))
        whole = self.sequence_hashes(self.bounds[:-1][short], lengths[short])
        return np.concatenate([self.text[at], short]), np.concatenate([hashes, whole])


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets, values


def split_words(texts: pa.Array, alphabet: Alphabet, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of an Arrow array of texts, slice by slice. A null text has no words."""
    if not len(texts):
        return
    offsets, values = _layout(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        cut = offsets[first : last + 1] - offsets[first]
        yield _slice_words(values[offsets[first] : offsets[last]], cut, first, alphabet)
        first = last


def _slice_words(data: np.ndarray, cut: np.ndarray, first: int, alphabet: Alphabet) -> Words:
    count = len(cut) - 1
    inside = alphabet.in_word[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = cut[:-1] < cut[1:]
    heads, tails = cut[:-1][filled], cut[1:][filled] - 1
    begin[heads], end[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    text = np.searchsorted(cut, starts, side="right") - 1
    up, down = _BYTE_POWERS.upto(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[alphabet.fold[data]] * up, out=total[1:])
    sums = (total[ends] - total[starts]) * down[starts]
    hashes = mix(sums ^ ((ends - starts).astype(np.uint64) * _SEQUENCE))
    bounds = np.searchsorted(text, np.arange(count + 1))
    return Words(first, count, data, starts, ends, text, hashes, bounds)
