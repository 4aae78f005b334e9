"""Document fingerprints by one-permutation MinHash, and documents' neighbours.

Each word shingle is hashed once; the hash's top bits are its bin, and a bin
keeps its least hash. A bin without shingles takes the value of the filled bin
that comes first in the bin's own random order of all bins (optimal
densification: every empty bin chooses independently and evenly among the
filled ones). Of each bin the ``BITS`` low-order bits are stored as one hex
digit. Two fingerprints agree by chance in one of ``2 ** BITS`` bins, and
:func:`likeness` takes that out.

Everything is column expressions on the row: sorting a text's hashes brings the
bins' least ones to the front of each bin, and no row meets another.
:func:`with_next` gives every row the row that follows it by key: rows go to
buckets between keys that exist in the table, and each bucket's first row also
goes to the bucket before it as a guest, so one shuffle of the rows is enough.

Defined results: a null text is an empty one; texts without words have the empty
fingerprint, which is like itself (1) and like no other (0); a text of fewer
than ``WORDS`` words has its whole word sequence as its only shingle; equal keys
are ordered by the text's hash, rows equal in both are alike; the row after the
last is the first, so a single row follows itself; no rows give no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.ordering import global_index
from .common import ascii_lower, unclashed, words_of

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 4
_LOW = (1 << BITS) - 1
# Rows meant for a bucket of neighbours, and the bound of the bucket count.
BUCKET_ROWS = 2_000
MAX_BUCKETS = 1 << 14


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS)


def _low(h: Column) -> Column:
    return h.bitwiseAND(F.lit(_LOW).cast("long"))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of the column ``text`` as ``name``: ``BINS``
    hex digits, or an empty string without words."""
    p = unclashed(df, "words", "hashes", "least", "size")
    columns = [c for c in df.columns if c != name]
    words, hashes, least = (F.col(p + x) for x in ("words", "hashes", "least"))
    df = df.withColumn(p + "words", F.transform(words_of(ascii_lower(F.col(text))), lambda w: F.xxhash64(w)))
    several = F.transform(
        F.sequence(F.lit(0), F.size(words) - WORDS),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]))
    df = df.select(*columns, F.sort_array(
        F.when(F.size(words) >= WORDS, several)
        .when(F.size(words) > 0, F.array(F.xxhash64(words)))
        .otherwise(F.array().cast("array<bigint>"))).alias(p + "hashes"))
    df = df.select(*columns, F.filter(
        hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1)))).alias(p + "least"))
    # one number per bin: the bin above the bits that are stored
    own = F.transform(least, lambda h: F.shiftleft(_bin(h), BITS) + _low(h))
    empty = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), F.transform(least, _bin))
    chosen = lambda i: F.array_min(F.transform(
        least, lambda h: F.xxhash64(i, _bin(h)).bitwiseAND(F.lit(~_LOW).cast("long")) + _low(h)))
    filled = F.transform(empty, lambda i: F.shiftleft(i, BITS) + _low(chosen(i)))
    digits = F.transform(F.sort_array(F.concat(own, filled)), lambda v: F.hex(_low(v)))
    return df.select(*columns, F.when(F.size(least) == 0, "").otherwise(
        F.lower(F.array_join(digits, ""))).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprints' shingle sets."""
    x, y = a.cast("binary"), b.cast("binary")
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: x.substr(i, F.lit(1)) == y.substr(i, F.lit(1))))
    chance = 1.0 / (1 << BITS)
    return (F.when((a == "") | (b == ""), (a == b).cast("double"))
            .otherwise(F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))))


def with_next(df: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<column>``: the columns of the row after it by ``key``
    (the first row after the last)."""
    p = unclashed(df, "h", "key", "bucket", "guest", "idx")
    df = df.withColumn(p + "h", F.xxhash64(F.col(text)))
    order = [F.col(key).asc_nulls_first(), F.col(p + "h")]
    ranked = global_index(df.select(key, p + "h"), order, index_col=p + "idx")
    n = ranked.count()
    step = max(-(-n // MAX_BUCKETS), BUCKET_ROWS)
    # at most MAX_BUCKETS keys: the first of every bucket, once each
    firsts = ranked.where(F.col(p + "idx") % step == 0).drop(p + "idx").distinct().orderBy(*order).collect()
    kind = T.ArrayType(T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("h", T.LongType())]))
    bounds = F.from_json(F.lit(json.dumps([{"k": r[key], "h": r[p + "h"]} for r in firsts], default=str)), kind)
    own = F.struct(F.col(key).alias("k"), F.col(p + "h").alias("h"))
    # the last bucket whose first key is not above the row's, by halving
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(len(firsts), 1).bit_length()))])
    bucket = F.aggregate(steps, F.lit(-1), lambda at, s: F.when(
        (at + s < len(firsts)) & (F.get(bounds, at + s) <= own), at + s).otherwise(at))
    df = df.withColumn(p + "bucket", bucket)
    at = F.col(p + "bucket")
    is_first = F.get(bounds, at) == own
    before = F.pmod(at - 1, F.lit(max(len(firsts), 1)))
    placed = df.select(*[c for c in df.columns if c != p + "bucket"], F.posexplode(
        F.when(is_first, F.array(at, before)).otherwise(F.array(at))).alias(p + "guest", p + "bucket"))
    window = Window.partitionBy(p + "bucket").orderBy(p + "guest", *order)
    placed = placed.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return placed.where(F.col(p + "guest") == 0).drop(p + "guest", p + "bucket", p + "h")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the following one."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - quarter), following.substr(F.lit(1), quarter))
