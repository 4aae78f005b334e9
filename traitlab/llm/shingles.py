"""Hashed word shingles of whole texts in Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
CHUNK_BYTES = 4 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lowered) of large-string texts without nulls,
    and the offsets of each text's words."""
    # a copy, since buffers of a slice would be folded whole
    texts = texts.take(pa.array(np.arange(len(texts))))
    # A-Z are single bytes in UTF-8 and no part of another character
    raw = texts.buffers()[2]
    if raw is not None:
        folded = pa.py_buffer(raw.to_pybytes().translate(FOLD))
        texts = pa.Array.from_buffers(texts.type, len(texts), [None, texts.buffers()[1], folded],
                                      offset=texts.offset)
    for c in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, c, " ")
    split = pc.split_pattern(texts, " ")
    units, bounds = split.flatten(), split.offsets.to_numpy()
    filled = pc.not_equal(units, pa.scalar("", units.type)).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(filled)])[bounds]
    coded = units.filter(pa.array(filled)).dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_pylist()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    return known[coded.indices.to_numpy()], bounds


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, sorted distinct shingle hashes, digest of the word sequence).

    Shingles are ``WORDS`` consecutive words; a shorter text has its whole
    sequence as its only shingle, a text without words none.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        floor = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, floor + CHUNK_BYTES, "right")))
        words, bounds = word_hashes(texts.slice(row, stop - row))
        rolled = words.copy()
        for k in range(1, WORDS):
            n = max(len(words) - k, 0)
            rolled[:n] = _mixed(rolled[:n] + _MIX) ^ words[k:]
        rolled = _mixed(rolled + _MIX)
        for n in range(stop - row):
            a, b = int(bounds[n]), int(bounds[n + 1])
            own = words[a:b]
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            if b - a >= WORDS:
                yield row + n, np.unique(rolled[a:b - WORDS + 1]), digest
            elif b > a:
                yield row + n, np.frombuffer(digest[:8], np.uint64), digest
            else:
                yield row + n, np.zeros(0, np.uint64), digest
        pa.default_memory_pool().release_unused()
        row = stop
