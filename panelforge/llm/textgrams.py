"""Vectorised words and word n-grams of Arrow text columns (numpy).

A word is a maximal run of digits, letters ``a-z`` (``A-Z`` count as lower
case) and bytes of non-ASCII characters, so word borders can be found on the
UTF-8 bytes of a whole batch at once.  Words and n-grams are 64-bit hashes;
callers that must be exact compare the bytes behind a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
WORD = np.zeros(256, dtype=bool)
WORD[ord("0"):ord("9") + 1] = True
WORD[ord("a"):ord("z") + 1] = True
WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64); every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U64(0x2545F4914F6CDD1D)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Base^i and Base^-i modulo 2^64 for i < n (kept between calls up to one block)."""
    if len(_powers.get("up", ())) >= n:
        return _powers["up"], _powers["down"]
    size = max(n, BLOCK + 1)
    tables = []
    for base in (_BASE, _INVERSE):
        t = np.full(size, U64(base), dtype=U64)
        t[0] = 1
        tables.append(np.cumprod(t, dtype=U64))
    if size <= 2 * BLOCK:
        _powers["up"], _powers["down"] = tables
    return tables[0], tables[1]


@dataclass
class Words:
    """Words of a slice of rows: byte ranges, row of each word, 64-bit hash."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    def ngram(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``n`` words that lies in one row, and the index of its first word."""
        return ngrams(self.hash, self.row, n)


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(h) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    acc = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        acc = acc * _STEP + h[k: len(h) - n + 1 + k]
    first = np.flatnonzero(row[: len(acc)] == row[n - 1:])
    return mix(acc[first] + U64(n)), first


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the rows whose UTF-8 bytes are ``data[offsets[i]:offsets[i + 1]]``."""
    low = LOWER[data]
    is_word = WORD[low]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    opens[inner] = is_word[inner]
    closes = is_word.copy()
    closes[:-1] &= ~is_word[1:]
    closes[inner - 1] = is_word[inner - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    h = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        base = start[i]
        j = max(int(np.searchsorted(end, base + BLOCK, side="right")), i + 1)
        span = int(end[j - 1] - base)
        up, down = _power_tables(span + 1)
        total = np.zeros(span + 1, U64)
        np.cumsum(CODE[low[base:base + span]] * up[:span], dtype=U64, out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        h[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        i = j
    return Words(low, start, end, row, h)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column (null rows are empty)."""
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]]
    return raw, offsets - offsets[0]


def slices(column: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a text column of at most ``max_bytes`` each (a longer row is
    a range of its own): first row, end row, bytes, offsets."""
    raw, offsets = byte_view(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi
