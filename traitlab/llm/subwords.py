"""Subword ids of whole texts in Arrow batches.

Byte-level BPE never joins characters across a single space or line feed that
stands between two other characters, so a text can be cut there and each unit
(a word with the white space before it) encoded on its own: the ids of the
units, put together, are the ids of the text. Units repeat a lot, so a batch
encodes only those it has not met before and gathers the rest from a buffer.
Texts with any other white space pattern, or with an added token of the
vocabulary (such as an end-of-text mark) in them, are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from ..operators.lookup import _MULTIPLIERS, _chunks, _hashed
from .shingles import FOLD, word_hashes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Units remembered by one worker process before it starts afresh.
MAX_UNITS = 1_200_000
# Bytes of text encoded at a time; bounds the memory of one call.
CHUNK_BYTES = 4 << 20
# Texts that are encoded whole: white space other than single inner spaces
# and line feeds, or the mark itself.
MARK = "\x02"
IRREGULAR = ("[ \n][ \n]|^[ \n]|[ \n]$|[\t\x0b\x0c\r\x1c-\x1f\x02]|"
             "[\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}\\x{2029}\\x{202f}"
             "\\x{205f}\\x{3000}\\x{feff}]")
_PIECE = 4096


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _flat(units: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of large strings without nulls, one after another, and their bounds."""
    bounds = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
    data = units.buffers()[2]
    return memoryview(data)[bounds[0]:bounds[-1]].tobytes() if data else b"", bounds - bounds[0]


def _quoted(text: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class Encoder:
    """Encodes Arrow string arrays to (ids, offsets); keeps a unit cache."""

    def __init__(self, path: str = VOCABULARY):
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([IRREGULAR, *map(_quoted, added)])
        # characters of the byte-level alphabet in an entry = bytes it stands for
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(names.values()) + 2, np.int64)
        self.width[list(names.values())] = [len(x) for x in names]
        self._reset()

    def _reset(self) -> None:
        self.units = pa.array([], pa.large_string())
        self.start = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16)
        self.hashed = np.zeros(0, np.uint64)
        # hashes of the units in order, and the units' places
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int32)

    def _find(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The places of some units among those remembered, -1 if new, and the
        units' hashes. Hashes only point to a place; the units are compared."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *[_hashed(c, _MULTIPLIERS[0]) for c in _chunks(units)]])
        if not len(self.keys):
            return np.full(len(units), -1, np.int64), hashes
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = self.keys[at] == hashes
        place = np.where(hit, self.places[at], -1).astype(np.int64)
        same = pc.equal(self.units.take(pa.array(place[hit])), units.filter(pa.array(hit)))
        place[np.flatnonzero(hit)[~same.to_numpy(zero_copy_only=False)]] = -1
        return place, hashes

    def _hashes(self) -> np.ndarray:
        """Per unit the hash of its word, as ``word_hashes`` gives it."""
        fresh = self.units.slice(len(self.hashed))
        if len(fresh):
            raw, bounds = _flat(fresh)
            raw = raw.translate(FOLD)
            # a unit that begins a text or a line has a mark in front
            first = np.frombuffer(raw + b" ", np.uint8)[bounds[:-1]]
            marked = (np.diff(bounds) > 0) & ((first == ord(MARK)) | (first == ord("\n")))
            starts, stops = bounds[:-1] + marked, bounds[1:]
            own = map(xxhash.xxh3_64_intdigest, map(raw.__getitem__, map(slice, starts.tolist(), stops.tolist())))
            self.hashed = np.concatenate([self.hashed, np.fromiter(own, np.uint64, len(fresh))])
        return self.hashed

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Encode new units and append their ids to the buffer; their places.

        Units are joined into longer texts; a unit's ids are those covering
        its bytes, since byte-level ids stand for fixed byte strings. Units
        that begin a text have no white space in front and go one by one.
        """
        first = pc.starts_with(fresh, MARK)
        place = np.argsort(np.argsort(first.to_numpy(zero_copy_only=False), kind="stable")) + len(self.units)
        turn = np.argsort(hashes)
        into = np.searchsorted(self.keys, hashes[turn])
        self.keys = np.insert(self.keys, into, hashes[turn])
        self.places = np.insert(self.places, into, place[turn].astype(np.int32))
        begin, fresh = fresh.filter(first), fresh.filter(pc.invert(first))
        inner = pc.if_else(pc.starts_with(fresh, "\n"), fresh, pc.binary_join_element_wise(
            _text(""), fresh, _text(" ")))
        raw, ends = _flat(inner)
        stops = ends[[*range(0, len(inner), _PIECE), len(inner)]].tolist()
        texts = [raw[a:b].decode() for a, b in zip(stops, stops[1:])]
        joined = [np.asarray(x, np.uint16) for x in self._whole(texts)]
        bare = [np.asarray(x, np.uint16) for x in self._whole([u[1:] for u in begin.to_pylist()])]
        flat = np.concatenate([*joined, np.zeros(0, np.uint16)])
        counts = np.diff(np.searchsorted(np.cumsum(self.width[flat]), ends[1:], "left") + 1, prepend=0)
        counts = np.concatenate([counts, np.fromiter(map(len, bare), np.int64, len(bare))])
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.units = pa.concat_arrays([self.units, fresh, begin])
        self.start = np.concatenate([self.start, starts.astype(np.int32)])
        self.length = np.concatenate([self.length, counts.astype(np.int32)])
        self.ids = np.concatenate([self.ids, flat, *bare])
        return place

    def chunks(self, texts: pa.Array, words: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
        """(first row, ids, offsets) of consecutive slices of about
        ``chunk_bytes`` of text each; a longer text is a slice of its own.
        With ``words``, also the slices' word hashes and their offsets."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        row = 0
        while row < len(texts):
            floor = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, floor + chunk_bytes, "right")))
            yield row, *(self.encode_words if words else self.encode)(texts.slice(row, stop - row))
            pa.default_memory_pool().release_unused()
            row = stop

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of all texts one after another, and ``offsets`` (n + 1)."""
        return self._encode(texts, False)[:2]

    def encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`encode`, and what ``word_hashes`` gives for the texts."""
        return self._encode(texts, True)

    def _encode(self, texts: pa.Array, words: bool):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(pc.match_substring_regex(texts, self.whole), pc.equal(texts, ""))
        odd = odd.to_numpy(zero_copy_only=False)
        ids, lengths, place, bounds = self._regular(texts.filter(pa.array(~odd)) if odd.any() else texts)
        out = [(ids, lengths)]
        if words:
            out.append((self._hashes()[place], np.diff(bounds)))
        if odd.any():
            rest = texts.filter(pa.array(odd))
            whole = [[np.asarray(x, np.uint16) for x in self._whole(rest.to_pylist())]]
            if words:
                hashes, ends = word_hashes(rest)
                whole.append(np.split(hashes, ends[1:-1]))
            out = [_merged(odd, *x, y) for x, y in zip(out, whole, strict=True)]
        return [y for flat, sizes in out for y in (flat, np.concatenate([[0], np.cumsum(sizes)]))]

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ids per text, the texts' units and their bounds."""
        if not len(texts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        marked = pc.binary_join_element_wise(
            _text(MARK), pc.replace_substring(texts, "\n", " \n"), _text(""))
        split = pc.split_pattern(marked, " ")
        bounds, units = split.offsets.to_numpy(), split.flatten()
        coded = units.dictionary_encode()
        known, hashes = self._find(coded.dictionary)
        new = known < 0
        if len(self.units) and len(self.units) + np.count_nonzero(new) > MAX_UNITS:
            self._reset()
            return self._regular(texts)
        if new.any():
            known[new] = self._learn(coded.dictionary.filter(pa.array(new)), hashes[new])
        place = known[coded.indices.to_numpy()]
        length = self.length[place]
        ends = np.cumsum(length, dtype=np.int64)
        take = np.repeat(self.start[place] - (ends - length).astype(np.int32), length)
        take += np.arange(len(take), dtype=np.int32)
        return self.ids[take], np.diff(np.concatenate([[0], ends])[bounds]), place, bounds


def _merged(odd: np.ndarray, flat: np.ndarray, sizes: np.ndarray, whole: list) -> tuple[np.ndarray, np.ndarray]:
    """Values of regular and of odd texts in the texts' order, and their numbers."""
    regular = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
    a, b = iter(regular), iter(whole)
    parts = [next(b) if x else next(a) for x in odd]
    return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """The worker process's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
