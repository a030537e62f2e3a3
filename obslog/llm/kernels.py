"""Numpy kernels over Arrow string columns: slices, words and 64-bit content hashes.

A slice is a run of whole documents laid out as one byte array, so that every kernel
works on long arrays. Hashes are polynomials over per-byte random values modulo 2**64,
taken from prefix sums, and then mixed; equal bytes have equal hashes in every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Bytes of words: ASCII digits and letters, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of words: everything but the space and the bytes 9 to 13.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False

_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept for the worker's life."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hashes:
    """Hashes of any byte span of a slice."""

    def __init__(self, data: np.ndarray, value: np.ndarray = BYTE_VALUE):
        terms = value[data]
        terms *= _power(_BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.inverse = _power(_BASE_INVERSE, len(data) + 1)

    def raw(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def of(self, start, end) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


def slices(column: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about `budget` bytes; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + budget, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, which never cross documents,
    and for each document the index of its first word (one more entry than documents)."""
    inside = of_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with A-Z taken as a-z."""
    return Hashes(FOLD[data]).of(starts, ends)


_COMBINE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of values[i : i + n] at i, for all i that leave room."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = values[:m] * _COMBINE[0]
    for i in range(1, n):
        out = out + values[i : i + m] * _COMBINE[i]
    return mix(out)


def sequence_hash(values: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence, apart from the hashes of n-grams of the same length or another."""
    out = np.full(1, len(values), np.uint64)
    for v in values:
        out = mix(out * _COMBINE[1] + v)
    return out[0]
