"""Hierarchical multi-length packing of tokenized documents.

Every document (its ids and one end id) is cut into full windows of the
longest context; the rest is routed to the smallest context tier that holds
it. Tiers are packed from the longest down: a window takes the largest item
of its own tier, its gap is filled best-fit from the items that remain (mostly
shorter tiers), and the last bit of a gap is filled by cutting the longest
item, whose rest goes back to its tier. A window of any tier is thus exactly
full; only what is left at the end of a task makes one short sequence.
Sequences of one tier are dealt into step groups of equal token count, in
serpentine order of their attention cost, so that steps take equally long.

One pass over each input partition, without a shuffle: a task holds at most
``POOL_TOKENS`` pending ids. Sequence and step numbers carry the partition
number in their upper bits, so a retried task gives the same rows.

Defined results: null or empty text is the end id alone; repeated rows are
packed one by one; an empty table gives no rows; of the input only the id
column is carried, other columns may have any name or value.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from .subwords import VOCABULARY, encoder

TIERS = (2048, 1024, 512, 256)
# What is left at the end of a task is cut into these, then one short sequence.
TAIL = (1024, 512, 256, 128, 64)
END_ID = 1
STEP_TOKENS = 16_384
POOL_TOKENS = 4_000_000
_ID_BITS = 33


class Packer:
    """Packs the documents of one task; ``add`` and ``finish`` fill ``rows``."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.base = task << _ID_BITS
        self.sequences = self.steps = 0
        self.pool: list[tuple[int, int]] = []  # (length, key), sorted
        self.items: dict[int, tuple] = {}      # key -> (doc_id, start, ids, doc_tokens)
        self.key = 0
        self.ready: dict[int, list] = {}       # context -> [pieces of a sequence]
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        window, total = self.tiers[0], len(ids)
        full = total - total % window
        for start in range(0, full, window):
            self.ready.setdefault(window, []).append([(doc_id, start, ids[start:start + window], total)])
        if full < total:
            self._put((doc_id, full, ids[full:], total))
        self.held += total
        if self.held >= POOL_TOKENS:
            self._pack()
            self._deal(False)

    def finish(self) -> None:
        self._pack()
        rest = [self.items.pop(key) for _, key in reversed(self.pool)]
        self.pool.clear()
        left = sum(len(x[2]) for x in rest)
        for context in (*self.tiers, *TAIL):
            while left >= context:
                rest = self._cut_off(rest, context)
                left -= context
        if rest:
            self.ready.setdefault(left, []).append(rest)
        self._deal(True)

    def _put(self, item: tuple) -> None:
        self.key += 1
        self.items[self.key] = item
        insort(self.pool, (len(item[2]), self.key))

    def _take(self, place: int) -> tuple:
        return self.items.pop(self.pool.pop(place)[1])

    def _cut_off(self, items: list[tuple], size: int) -> list[tuple]:
        """One sequence of exactly ``size`` from the front; returns the rest."""
        pieces = []
        for n, (doc, start, ids, total) in enumerate(items):
            piece = ids[:size]
            pieces.append((doc, start, piece, total))
            size -= len(piece)
            if not size:
                rest = [(doc, start + len(piece), ids[len(piece):], total)] if len(piece) < len(ids) else []
                self.ready.setdefault(sum(len(p[2]) for p in pieces), []).append(pieces)
                return rest + items[n + 1:]
        raise ValueError("fewer ids than the sequence needs")

    def _pack(self) -> None:
        """Fill windows tier by tier until the pool can't fill one."""
        left = sum(n for n, _ in self.pool)
        for context, shorter in zip(self.tiers, (*self.tiers[1:], 0), strict=True):
            while left >= context:
                place = bisect_right(self.pool, (context, self.key + 1)) - 1
                if place < 0 or self.pool[place][0] <= shorter:
                    break
                gap, pieces = context, []
                while gap:
                    place = bisect_right(self.pool, (gap, self.key + 1)) - 1
                    if place >= 0:
                        item = self._take(place)
                    else:
                        doc, start, ids, total = self._take(-1)
                        item = (doc, start, ids[:gap], total)
                        self._put((doc, start + gap, ids[gap:], total))
                    pieces.append(item)
                    gap -= len(item[2])
                self.ready.setdefault(context, []).append(pieces)
                left -= context
        self.held = left

    def _deal(self, last: bool) -> None:
        """Number the sequences and deal them into step groups; what fills no
        group waits for more, or makes a last short one."""
        for context, found in self.ready.items():
            per_step = max(1, STEP_TOKENS // context)
            whole = len(found) - len(found) % per_step
            self._step(found[:whole], whole // per_step, context)
            if last:
                self._step(found[whole:], 1, context)
            self.ready[context] = [] if last else found[whole:]
        self.held = sum(n for n, _ in self.pool) + sum(
            context * len(found) for context, found in self.ready.items())

    def _step(self, sequences: list, steps: int, context: int) -> None:
        """Deal sequences of one context in serpentine order of their cost."""
        cost = [sum(len(p[2]) ** 2 for p in pieces) for pieces in sequences]
        for rank, n in enumerate(sorted(range(len(sequences)), key=cost.__getitem__)):
            turn, place = divmod(rank, steps)
            step = self.base + self.steps + (place if turn % 2 == 0 else steps - 1 - place)
            offset = 0
            for doc, start, ids, total in sequences[n]:
                self.rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total,
                                  self.base + self.sequences, offset, context, step))
                offset += len(ids)
            self.sequences += 1
        self.steps += steps if sequences else 0


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         tiers: tuple[int, ...] = TIERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: the document's id, ``start`` (its ids before the
    piece), ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence, ``context`` (the sequence's
    length) and ``step_id``."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField(doc_id, id_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("context", T.IntegerType()),
        T.StructField("step_id", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, out = encoder(vocabulary), Packer(TaskContext.get().partitionId(), tiers), None

        def drain():
            columns = list(zip(*packer.rows, strict=True)) if packer.rows else [[]] * len(out)
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

        for batch in batches:
            if out is None:
                out = pa.schema([(doc_id, batch.schema.field(0).type), ("start", pa.int64()),
                                 ("length", pa.int64()), ("ids", pa.binary()),
                                 ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                                 ("offset", pa.int64()), ("context", pa.int32()),
                                 ("step_id", pa.int64())])
            docs_here = batch.column(0).to_pylist()
            for row, ids, offsets in coder.chunks(batch.column(1)):
                for n in range(len(offsets) - 1):
                    own = np.append(ids[offsets[n]:offsets[n + 1]], np.uint16(END_ID))
                    packer.add(docs_here[row + n], own)
                if packer.rows:
                    yield drain()
        if out is not None:
            packer.finish()
            yield drain()

    return docs.select(doc_id, text).mapInArrow(run, schema)
