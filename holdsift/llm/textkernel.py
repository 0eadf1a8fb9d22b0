"""Word tables of Arrow string columns in NumPy: word bounds and 64-bit hashes for a stretch of whole documents.

Used inside Arrow tasks. A batch is taken in stretches of about a megabyte of whole texts, so memory follows the
longest text and not the batch. Words are runs of bytes other than space and tab to carriage return; in UTF-8 those
bytes never lie inside a longer sign.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_STEP = np.uint64(0xD1342543DE82EF95)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            ones = lambda v: np.concatenate([np.ones(1, np.uint64), np.full(n - 1, v, np.uint64)])
            self.up, self.down = np.multiply.accumulate(ones(_BASE)), np.multiply.accumulate(ones(inverse))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def stretches(column: pa.Array, size: int = STRETCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


class Words:
    """Words of a stretch: ``start``/``end`` byte bounds, ``hash``, and ``first``: each document's first word, plus the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        n = len(data)
        blank = _BLANK[data]
        before = np.ones(n + 1, bool)
        before[1:] = blank
        before[offsets] = True
        after = np.ones(n + 1, bool)
        after[:n] = blank
        after[offsets] = True
        self.start = np.flatnonzero(~blank & before[:n])
        self.end = np.flatnonzero(~blank & after[1:]) + 1
        up, down = _POWERS.upto(max(n, 1))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER if lower else _VALUE)[data] * up[:n], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        self.hash = mix64((total[self.end] - total[self.start]) * down[self.start] + length)
        self.first = np.searchsorted(self.start, offsets)
        self.blank = blank

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``width`` words inside a document, and each document's first window, plus the end."""
        n = len(self.hash) - width + 1
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        first = np.concatenate([[0], np.cumsum(counts)])
        if n <= 0:
            return np.zeros(0, np.uint64), first
        acc = np.zeros(n, np.uint64)
        for k in range(width):
            acc = acc * _STEP + self.hash[k: k + n]
        starts = np.repeat(self.first[:-1], counts) + np.arange(first[-1]) - np.repeat(first[:-1], counts)
        return mix64(acc[starts]), first


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a short run of words as a whole."""
    acc = np.full(1, len(hashes), np.uint64)
    for h in hashes:
        acc = acc * _STEP + h
    return mix64(acc ^ _BASE)[0]
