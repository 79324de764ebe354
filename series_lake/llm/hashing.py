"""64-bit hashes of words and shingles for whole batches of text, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once: their arrays should stay in a core's cache.
PART = 1 << 17


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order. Sorting beats the hash table of ``np.unique`` by far where most
    values differ."""
    x = np.sort(x)
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def _series(seed: int, n: int) -> np.ndarray:
    return mixed(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Word hashes of byte strings; words are ``[^\\x20\\x09-\\x0D]+``, optionally A-Z lower-cased."""

    def __init__(self, lower: bool):
        self.space = np.zeros(256, dtype=bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.table = _series(1, 256)
        if lower:
            self.table[0x41:0x5B] = self.table[0x61:0x7B]
        self.powers = _series(2, 1 << 16) | np.uint64(1)

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, byte positions of the words)."""
        hashes, places, at = [], [], 0
        while at < len(data):
            end = min(len(data), at + PART)
            while end < len(data) and not self.space[data[end - 1]]:
                ahead = self.space[data[end : end + PART]]
                end += int(ahead.argmax()) + 1 if ahead.any() else len(ahead)
            h, p = self._part(data[at:end])
            hashes.append(h)
            places.append(p + at)
            at = end
        return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def _part(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = self.space[data]
        begins = ~gap
        begins[1:] &= gap[:-1]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        data, gap = data[starts[0] :], gap[starts[0] :]
        rel = starts - starts[0]
        lengths = np.diff(np.append(rel, len(data)))
        offset = np.arange(len(data)) - np.repeat(rel, lengths)
        value = self.table[data] * self.powers[offset & 0xFFFF]
        if lengths.max() > 0xFFFF:
            far = np.flatnonzero(offset > 0xFFFF)
            value[far] *= self.powers[(offset[far] >> 16) & 0xFFFF]
        value[gap] = 0
        return mixed(np.add.reduceat(value, rel)), starts


def texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, bytes) of a string column without copying; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(n):
        yield i, content[bounds[i] : bounds[i + 1]] if valid[i] else content[:0]


def grouped(column: pa.Array, limit: int = PART) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of consecutive rows of about ``limit`` bytes: (first row, their bytes)."""
    first, run, size = 0, [], 0
    for i, data in texts(column):
        if run and size + len(data) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def shingle_sets(column: pa.Array, words: Words, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its word shingles). Fewer words than ``width`` make one
    shingle of all; no words none."""
    newline = np.array([0x0A], dtype=np.uint8)
    for first, run in grouped(column):
        joined = np.concatenate([x for data in run for x in (data, newline)])
        hashes, places = words(joined)
        bounds = np.searchsorted(places, np.cumsum([0, *[len(d) + 1 for d in run]]))
        rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
        for j in range(width):
            rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(rolled)])
        for k in range(len(run)):
            low, high = bounds[k], bounds[k + 1]
            if high - low >= width:
                yield first + k, distinct(rolled[low : high - width + 1])
            elif high > low:
                one = np.zeros(1, dtype=np.uint64)
                for h in hashes[low:high]:
                    one = mixed(one * np.uint64(0x9E3779B97F4A7C15) + h)
                yield first + k, mixed(one + np.uint64(high - low))
            else:
                yield first + k, rolled[:0]
