"""Exact lookup of many strings in a fixed set of keys, in numpy.

The keys' 64-bit hashes are sorted once, on the driver, and sent with the
keys; finding a batch of strings hashes their bytes (a polynomial over the flat
buffer, no loop over strings), searches the sorted hashes, and compares the
strings with the keys they hit. A batch costs what its own strings cost, times
the logarithm of the number of keys; nothing is built again per batch or task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK_BYTES = 4 << 20
_MULTIPLIERS = tuple(int(m) | 1 for m in np.random.default_rng(11).integers(1 << 62, 1 << 63, 8, dtype=np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunks(strings: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(strings):
        floor = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, floor + _CHUNK_BYTES, "right")))
        yield strings.slice(row, stop - row)
        row = stop


def _hashed(strings: pa.Array, multiplier: int) -> np.ndarray:
    """64-bit hashes of large strings without nulls."""
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.zeros(0, np.uint8)
    length = np.diff(bounds)
    starts = bounds[:-1] - bounds[0]
    powers = np.cumprod(np.full(max(int(length.max(initial=0)), 1), multiplier, np.uint64))
    terms = (raw.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(raw)) - np.repeat(starts, length)]
    out = np.zeros(len(length), np.uint64)
    filled = length > 0
    if filled.any():
        out[filled] = np.add.reduceat(terms, starts[filled])
    return _mixed(out ^ length.astype(np.uint64))


class KeyIndex:
    """Positions of strings in ``keys`` (distinct, without nulls)."""

    def __init__(self, keys: pa.Array | pa.ChunkedArray):
        self.keys = pa.concat_arrays(keys.chunks) if isinstance(keys, pa.ChunkedArray) else keys
        self.keys = self.keys.cast(pa.large_string())
        for self.multiplier in _MULTIPLIERS:
            hashes = np.concatenate([np.zeros(0, np.uint64), *[_hashed(c, self.multiplier) for c in _chunks(self.keys)]])
            self.order = np.argsort(hashes)
            self.sorted = hashes[self.order]
            # two keys with one hash would hide each other: take the next multiplier
            if not (self.sorted[1:] == self.sorted[:-1]).any():
                return
        raise ValueError("keys are not distinct")

    def find(self, strings: pa.Array) -> np.ndarray:
        """The position of each string, -1 where it is null or no key."""
        strings = strings.cast(pa.large_string())
        known = strings.is_valid().to_numpy(zero_copy_only=False)
        strings = pc.fill_null(strings, "")
        if not len(self.keys):
            return np.full(len(strings), -1, np.int64)
        found = []
        for part in _chunks(strings):
            at = np.minimum(np.searchsorted(self.sorted, hashes := _hashed(part, self.multiplier)), len(self.sorted) - 1)
            at, hit = self.order[at], self.sorted[at] == hashes
            same = pc.equal(self.keys.take(pa.array(at[hit])), part.filter(pa.array(hit)))
            hit[hit] = same.to_numpy(zero_copy_only=False)
            found.append(np.where(hit, at, -1))
        return np.where(known, np.concatenate([np.zeros(0, np.int64), *found]), -1)
