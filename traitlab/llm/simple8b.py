"""Token-id tables in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector and 60 data bits: a fixed count of values
of a fixed width, the most that fit at that place. Values of more than 59 bits
are escapes: their word holds an index into a list of raw 64-bit values.
Runs of zeros have selectors of their own.

Block format (little endian): ``S8B1``, then as 32-bit numbers the counts of
values, words, escapes and checkpoints; one 32-bit output position for every
64th word (decoding can start at any of them); the words; the escapes.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"S8B1"
CHECKPOINT_WORDS = 64
# Selector -> (values in a word, bits of a value).
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
# The last selector with this bit pattern above the index marks an escape.
ESCAPE = np.uint64(1) << np.uint64(59)
_COUNTS = np.array([n for n, _ in SELECTORS], np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """The selector of a word that would begin at each place."""
    n = len(values)
    chosen = np.full(n, 15, np.uint8)
    for selector in range(14, -1, -1):
        count, width = SELECTORS[selector]
        if count > n:
            continue
        wide = np.zeros(n + 1, np.int32)
        np.cumsum(values >= np.uint64(1 << width), out=wide[1:])
        fits = wide[count:] == wide[:n + 1 - count]
        if not fits.any():
            break  # a narrower width fits nowhere either
        chosen[:n + 1 - count][fits] = selector
    return chosen


def encode(values: np.ndarray) -> bytes:
    """One block of unsigned integers below 2**64."""
    values = np.ascontiguousarray(values, np.uint64)
    selector_at = _runs(values)
    step = _COUNTS[selector_at].tolist()
    starts, place, n = [], 0, len(step)
    while place < n:
        starts.append(place)
        place += step[place]
    starts = np.array(starts, np.int64)
    selectors = selector_at[starts] if n else np.zeros(0, np.uint8)
    words = selectors.astype(np.uint64) << np.uint64(60)
    escapes = np.zeros(0, np.uint64)
    for s in np.unique(selectors):
        count, width = SELECTORS[s]
        if not width:
            continue
        at = np.flatnonzero(selectors == s)
        first = starts[at]
        if count == 1:
            data = values[first]
            big = data >= ESCAPE
            escapes = data[big]
            data[big] = ESCAPE | np.arange(len(escapes), dtype=np.uint64)
        else:
            data = values[first]
            for k in range(1, count):
                data |= values[first + k] << np.uint64(k * width)
        words[at] |= data
    head = np.array([n, len(words), len(escapes), len(starts[::CHECKPOINT_WORDS])], "<u4")
    return b"".join([MAGIC, head.tobytes(), starts[::CHECKPOINT_WORDS].astype("<u4").tobytes(),
                     words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def decode(block: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """The values at ``first`` to ``stop`` of a block, by default all.

    The checkpoints tell which words hold them; only those are unpacked.
    """
    if block[:4] != MAGIC:
        raise ValueError("not a Simple-8b block")
    n, n_words, n_escapes, n_marks = np.frombuffer(block, "<u4", 4, 4).tolist()
    marks = np.frombuffer(block, "<u4", n_marks, 20)
    words = np.frombuffer(block, "<u8", n_words, 20 + 4 * n_marks)
    escapes = np.frombuffer(block, "<u8", n_escapes, 20 + 4 * n_marks + 8 * n_words)
    stop = n if stop is None else min(stop, n)
    if first >= stop:
        return np.zeros(0, np.uint64)
    a = int(np.searchsorted(marks, first, "right")) - 1
    b = int(np.searchsorted(marks, stop, "left"))
    words, origin = words[a * CHECKPOINT_WORDS:b * CHECKPOINT_WORDS], int(marks[a])
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    counts = _COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selectors):
        count, width = SELECTORS[s]
        if not width:
            continue
        at = np.flatnonzero(selectors == s)
        data = words[at] & np.uint64((1 << 60) - 1)
        if count == 1:
            big = (data & ESCAPE) != 0
            data[big] = escapes[(data[big] ^ ESCAPE).astype(np.int64)]
            out[starts[at]] = data
        else:
            mask = np.uint64((1 << width) - 1)
            for k in range(count):
                out[starts[at] + k] = (data >> np.uint64(k * width)) & mask
    return out[first - origin:stop - origin]
