"""Hashes over the bytes of a batch of texts, whole arrays at a time (numpy).

The bytes of many texts lie in one array. A prefix sum of keyed byte values
times powers of an odd number gives a 64-bit hash of any span in O(1), so words
and chunks need no Python loop. Used inside Arrow batches only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 500_000  # bytes of text worked on together; a worker's arrays are some hundred times that

_MULT = np.uint64(0x9E3779B97F4A7C15)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step; equal inputs give equal outputs, others look random."""
    x = x + _MULT
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    return splitmix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 20))


class SpanHash:
    """64-bit hashes of spans of a byte array, for one seed."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int):
        p = int(splitmix(np.array([seed], np.uint64))[0]) | 1
        pw, inv = SpanHash._powers.get(seed, (np.empty(0, np.uint64),) * 2)
        if len(pw) < len(data) + 1:
            n = max(len(data) + 1, SLICE)
            ones = lambda x: np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(x))]), dtype=np.uint64)
            pw, inv = ones(p), ones(pow(p, -1, 1 << 64))
            SpanHash._powers[seed] = (pw, inv)
        self.inv = inv
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values(seed)[data] * pw[:len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return splitmix((self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(np.uint64))


def text_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows) for runs of rows
    with about ``most`` bytes; a longer text is a run of its own. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes in the class ``inside`` (256 booleans), in order."""
    n = len(data)
    if not n:
        return (np.empty(0, np.int64),) * 3
    on = inside[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(on & np.concatenate([[True], ~on[:-1] | first[1:n]]))
    end = np.flatnonzero(on & np.concatenate([~on[1:] | first[1:n], [True]])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes other than space and \\t..\\r."""
    return spans(data, offsets, ~_SPACE)
