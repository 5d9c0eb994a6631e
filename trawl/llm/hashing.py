"""Vectorised hashing of words and n-grams over the UTF-8 bytes of Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SLICE_BYTES = 2_000_000
SLICE_ROWS = 1 << 16

#: Letters, digits and every byte of a multi-byte character are word bytes.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


@lru_cache(maxsize=8)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        a = np.full(n, base, dtype=U)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n."""
    up, down = _powers(max(16, int(n).bit_length()))
    return up[: n + 1], down[: n + 1]


def prefix(values: np.ndarray) -> np.ndarray:
    """H with H[j] = sum of values[i] * BASE**i over i < j."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values.astype(U) * up[: len(values)], out=out[1:])
    return out


def range_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], equal for equal contents wherever they lie."""
    _, down = powers(len(h))
    return mix((h[end] - h[start]) * down[start])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the rows' offsets in them; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(at) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes and SLICE_ROWS rows at most; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = min(row + SLICE_ROWS, max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1))
        yield row, end
        row = end


class Words:
    """The words of consecutive texts: `hash`, `start`, `end` (bytes) and the texts' `first` words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        is_word = WORD_BYTE[data]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begins[inner] = is_word[inner]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:]
        ends[inner - 1] = is_word[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.hash = range_hash(prefix(FOLD[data].astype(U) + U(1)), self.start, self.end)
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.hash)

    def document(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def left(self) -> np.ndarray:
        """For each word the number of words from it to its text's end."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word runs and the indexes of their first words; no run crosses texts."""
        at = np.arange(len(self.hash))
        ends = np.repeat(self.first[1:], self.counts)
        at = at[at + n <= ends]
        return range_hash(prefix(self.hash), at, at + n), at


def char_positions(data: np.ndarray) -> np.ndarray:
    """For each byte offset (and the end) the number of characters before it."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
