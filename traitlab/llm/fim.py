"""Fill-in-the-middle rewriting of texts, cut at positions in the first, middle
and last part given in units (a run of A-Z and a-z, or any other character).

A text is split into fixed blocks of its UTF-8 bytes. Two Fenwick trees over the
blocks hold the number of units that begin in each and of its code points; the
descent by powers of two finds the block in which a wanted unit begins, with
the code points before it, and only that block is searched for the position.
Rows are cut in Arrow batches, ``CHUNK_BYTES`` of text at a time; everything
else is column expressions, so a lost task is just run again.

Defined results: a null text is an empty one and stays plain; a null id has the
decimal form of an empty string; repeated rows give equal results; an empty
table gives no rows; all other columns are carried (those called like a result
column are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Sentinels of prefix, suffix and middle, and the shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
BLOCK = 1024
CHUNK_BYTES = 4 << 20


class Fenwick:
    """Prefix sums of two counters over blocks, searched by the first one."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        self.units, self.points = units.tolist(), points.tolist()
        self.size = len(self.units)
        for n in range(1, self.size + 1):
            if (up := n + (n & -n)) <= self.size:
                self.units[up - 1] += self.units[n - 1]
                self.points[up - 1] += self.points[n - 1]

    def block_of(self, unit: int) -> tuple[int, int, int]:
        """The block in which the unit of this number (from 0) begins, and the
        units and code points before that block."""
        at = units = points = 0
        step = 1 << self.size.bit_length() >> 1
        while step:
            to = at + step
            if to <= self.size and units + self.units[to - 1] <= unit:
                at, units, points = to, units + self.units[to - 1], points + self.points[to - 1]
            step >>= 1
        return at, units, points


def _cut(starts: np.ndarray, heads: np.ndarray, picks: list[int]) -> tuple[int, int, int]:
    """Units of one text, and the code points before two units picked by number
    (taken modulo one more than the units; the smaller one first)."""
    edges = np.arange(0, len(starts), BLOCK)
    units, points = (np.add.reduceat(x, edges, dtype=np.int64) for x in (starts, heads))
    n, length = int(units.sum()), int(points.sum())
    tree = Fenwick(units, points)
    found = []
    for unit in sorted(p % (n + 1) for p in picks):
        block, skipped, before = tree.block_of(unit)
        if block == tree.size:
            found.append(length)
            continue
        a = block * BLOCK
        local = np.flatnonzero(starts[a:a + BLOCK])[unit - skipped]
        found.append(before + int(np.count_nonzero(heads[a:a + local])))
    return n, *found


def _chunks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        floor = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, floor + CHUNK_BYTES, "right")))
        yield row, texts.slice(row, stop - row)
        row = stop


_CUTS = pa.struct([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def cut_points(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """(units, code points before the first cut, before the second) of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    picks = [x.to_numpy(zero_copy_only=False) for x in (first, second)]
    out = np.zeros((len(texts), 3), np.int64)
    for row, part in _chunks(texts):
        bounds = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data = part.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        # a code point begins at every byte that does not go on with another's
        heads = (raw & 0xC0) != 0x80
        letters = ((raw | 0x20) - np.uint8(ord("a"))) < 26
        inner = letters.copy()
        inner[1:] &= letters[:-1]
        inner[bounds[:-1][bounds[:-1] < len(raw)]] = False
        starts = heads & ~inner
        for n in range(len(part)):
            a, b = int(bounds[n]), int(bounds[n + 1])
            if b > a:
                out[row + n] = _cut(starts[a:b], heads[a:b], [int(p[row + n]) for p in picks])
    return pa.StructArray.from_arrays([pa.array(out[:, k]) for k in range(3)], fields=list(_CUTS))


def draws(doc_id: str, seed: str) -> list[Column]:
    """Four numbers below 2**32 that the id and the seed decide."""
    key = F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return [F.conv(F.substr(F.sha2(key, 256), F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1:") -> DataFrame:
    """``docs`` with ``n_units``, ``form`` (plain, psm or spm), ``prefix_chars``,
    ``middle_chars`` (null when plain) and ``output``."""
    h = draws(doc_id, seed)
    body = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(body, F.lit(sentinel))
    plain = (body == "") | marked | (h[2] % 100 >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_PERCENT, "spm").otherwise("psm")
    cuts = F.arrow_udf(cut_points, "n long, a long, b long")
    kept = [c for c in docs.columns if c.lower() not in ("n_units", "form", "prefix_chars", "middle_chars", "output")]
    rows = docs.select(*docs.columns, cuts(body, h[0], h[1]).alias("_fim_cut"), form.alias("_fim_form"))
    a, b = F.col("_fim_cut.a").cast("int"), F.col("_fim_cut.b").cast("int")
    prefix, middle = body.substr(F.lit(1), a), body.substr(a + 1, b - a)
    suffix = body.substr(b + 1, F.length(body))
    form = F.col("_fim_form")
    output = (F.when(form == "plain", body)
              .when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)))
    cut = form != "plain"
    return rows.select(
        *kept, F.col("_fim_cut.n").alias("n_units"), form.alias("form"),
        F.when(cut, F.col("_fim_cut.a")).alias("prefix_chars"),
        F.when(cut, F.col("_fim_cut.b") - F.col("_fim_cut.a")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output: its parts put back between the sentinels,
    which no cut text holds, nor any join of a part with a sentinel."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda k: F.get(parts, F.lit(k))
    return (F.when(form == "plain", output)
            .when(form == "spm", F.concat(part(2), part(3), part(1)))
            .otherwise(F.concat(part(1), part(3), part(2))))
