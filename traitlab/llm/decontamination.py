"""Benchmark decontamination by spaced-seed hashing.

Documents and benchmark items become lower-cased words. At every position,
fixed masks pick some of the next ``SPAN`` words and ignore the others; the
picked words' hash is a seed, so passages with substituted words still share
seeds. Seeds of documents and items are joined, hits on the same alignment are
combined, and each alignment is verified: over ``REACH`` words before its first
seed and twice as many after it, the best stretch
(one point for an equal word, ``MISMATCH`` off for another) must reach
``MIN_SCORE`` points, or the share ``MIN_SHARE`` of the item's words must be
equal, so that short items tolerate substitutions as well. Every substitution of one
word that the verification accepts is found, in items of any length; of those of
two words, 96 to 98 in 100 for items of 14 to 16 words and all in longer ones. Items
of fewer than ``SPAN`` words match exactly, by the hash of their whole word sequence.

Long texts are cut into chunks that overlap by the reach, so a row stays small
whatever the text's length. The benchmark's seeds are broadcast in blocks below
a checked size; documents are never shuffled by word. Only hits, one row of
numbers each, are aggregated.

Defined results: null or empty texts and items match nothing; repeated documents are judged by their text alone;
empty tables give no hits and remove nothing; input columns are carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint_dir
from .common import BROADCAST_BYTES, broadcast_if_small, unclashed
from .licenses import normalized

# 1 picks a word, 0 ignores it.
MASKS = ("11011011", "11100111")
# With these, some mask ignores each of an item's places; needed where an item is
# so short that few alignments of the others lie in it.
EDGE_MASKS = ("00111111", "11111100")
EDGE_WORDS = 9
SPAN = 8
CHUNK = 1024
REACH = 64
MISMATCH = 3
MIN_SCORE = 12
MIN_SHARE = 0.85
# Bytes that a seed row takes in a broadcast hash table, about.
SEED_BYTES = 64


def text_words(text: Column) -> Column:
    core = normalized(text)
    return F.when(core != "", F.split(core, " ")).otherwise(F.array().cast("array<string>"))


def _seeds(words: Column, first: Column, count: Column, masks: tuple[str, ...] = MASKS) -> Column:
    """(hash, place) of every mask at places ``first`` to ``first + count``."""
    last = F.least(first + count, F.size(words) - SPAN + 1) - 1
    places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def picked(mask: str) -> Column:
        return F.transform(places, lambda i: F.struct(
            F.xxhash64(F.lit(mask), *[F.get(words, i + k) for k, bit in enumerate(mask) if bit == "1"])
            .alias("seed"), i.alias("place")))

    return F.concat(*map(picked, masks))


def _sequences(words: Column, first: Column, count: Column, lengths: list[int]) -> Column:
    """(hash, place) of all sequences of ``lengths`` words at places ``first``
    to ``first + count``."""
    def of(n: int) -> Column:
        last = F.least(first + count, F.size(words) - n + 1) - 1
        places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(
            F.xxhash64(F.lit(n), *[F.get(words, i + k) for k in range(n)]).alias("seed"), i.alias("place")))

    return F.concat(*map(of, lengths))


def _alignment_score(words: Column, item: Column, place: Column, item_place: Column) -> Column:
    """``best`` stretch and ``equal`` words of the alignment that puts
    ``place`` on ``item_place``."""
    shift = place - item_place
    low = F.greatest(F.lit(0), -shift, item_place - REACH)
    high = F.least(F.size(item), F.size(words) - shift, item_place + SPAN + 2 * REACH) - 1
    points = F.transform(F.sequence(low, high), lambda j: F.when(
        F.get(item, j) == F.get(words, j + shift), 1).otherwise(-MISMATCH))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("equal"))

    def step(state: Column, x: Column) -> Column:
        now = F.greatest(state["now"] + x, F.lit(0))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"),
                        (state["equal"] + F.when(x > 0, 1).otherwise(0)).alias("equal"))

    return F.aggregate(points, start, step)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Verified overlaps: (``doc_id``, the text's key ``k1`` and ``k2``,
    ``item_id``, ``score``, ``first_word``: the place of the first seed)."""
    checkpoint_dir(docs.sparkSession)
    items = (benchmark.select(F.col(item_id).alias("item"), text_words(F.col(item_text)).alias("item_words"))
             .where(F.size("item_words") > 0).dropDuplicates()
             .withColumn("item_key", F.xxhash64("item", "item_words")).checkpoint())
    # the edge masks are tried when an item is short enough to need them
    edged = not items.where(F.size("item_words").between(SPAN, EDGE_WORDS)).isEmpty()
    masks = MASKS + EDGE_MASKS if edged else MASKS
    own_seeds = lambda m: _seeds(F.col("item_words"), F.lit(0), F.size("item_words"), m)
    seeds = (items.select("item_key", F.explode(F.when(
        F.size("item_words") <= EDGE_WORDS, own_seeds(MASKS + EDGE_MASKS)).otherwise(own_seeds(MASKS))).alias("s"))
        .select("item_key", F.col("s.seed").alias("seed"), F.col("s.place").alias("item_place"))
        .checkpoint())
    lengths = sorted(r["n"] for r in items.select(F.size("item_words").alias("n"))
                     .where(F.col("n") < SPAN).distinct().collect())  # fewer than SPAN
    words_bytes = items.agg(F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "item_words"))), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(max(seeds.count() * SEED_BYTES, 4 * words_bytes) / BROADCAST_BYTES))

    own = docs.select(F.col(doc_id).alias("doc"), *_key(F.col(text)),
                      text_words(F.col(text)).alias("words"))
    left = F.greatest(F.col("chunk") - REACH, F.lit(0))
    cut = (own.withColumn("chunk", F.explode(F.when(F.size("words") >= min([SPAN, *lengths]), F.sequence(
        F.lit(0), F.size("words") - 1, F.lit(CHUNK)))))
        .select("doc", "k1", "k2", "chunk", left.alias("left"),
                F.slice("words", left + 1, F.col("chunk") - left + CHUNK + SPAN + 2 * REACH).alias("words")))
    # the words stay behind: a row per place has only numbers
    places = (cut.select("k1", "k2", "chunk", F.explode(_seeds(
        F.col("words"), F.col("chunk") - F.col("left"), F.lit(CHUNK), masks)).alias("s"))
        .select("k1", "k2", "chunk", F.col("s.seed").alias("seed"), F.col("s.place").alias("place")))
    found = None
    for k in range(blocks):
        # each block is a bounded part of the benchmark, see above
        here = F.broadcast(seeds.where(F.pmod("item_key", F.lit(blocks)) == k))
        hits = (places.join(here, "seed")
                .groupBy("k1", "k2", "chunk", "item_key", (F.col("place") - F.col("item_place")).alias("shift"),
                         F.floor(F.col("item_place") / REACH).alias("part"))
                .agg(F.min("item_place").alias("item_place")))
        found = hits if found is None else found.unionByName(hits)
    found = found.drop("part")
    if lengths:
        # the first exact place in a chunk stands for all
        whole = F.concat(*[F.when(F.size("item_words") == n, _sequences(
            F.col("item_words"), F.lit(0), F.lit(1), [n])).otherwise(
                F.array().cast("array<struct<seed:bigint,place:int>>")) for n in lengths])
        short = (items.where(F.size("item_words") < SPAN)
                 .select("item_key", F.get(whole, F.lit(0))["seed"].alias("seed")))
        exact = (cut.select("k1", "k2", "chunk", F.explode(_sequences(
            F.col("words"), F.col("chunk") - F.col("left"), F.lit(CHUNK), lengths)).alias("s"))
            .select("k1", "k2", "chunk", F.col("s.seed").alias("seed"), F.col("s.place").alias("place"))
            .join(broadcast_if_small(short), "seed")
            .groupBy("k1", "k2", "chunk", "item_key").agg(F.min("place").alias("shift"))
            .withColumn("item_place", F.lit(0)))
        found = found.unionByName(exact)
    found = found.checkpoint()
    small = 4 * words_bytes <= BROADCAST_BYTES
    place = F.col("item_place") + F.col("shift")
    return (cut.join(broadcast_if_small(found), ["k1", "k2", "chunk"])
            .join(F.broadcast(items) if small else items, "item_key")
            .withColumn("s", _alignment_score(F.col("words"), F.col("item_words"), place, F.col("item_place")))
            .withColumn("score", F.col("s.best"))
            .where((F.col("score") >= MIN_SCORE) | (F.col("s.equal") >= F.ceil(
                F.when(F.size("item_words") < SPAN, 1.0).otherwise(MIN_SHARE) * F.size("item_words"))))
            .groupBy("doc", "k1", "k2", "item")
            .agg(F.max("score").alias("score"), F.min(F.col("left") + place).alias("first_word"))
            .withColumnsRenamed({"doc": doc_id, "item": item_id}))


def _key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no benchmark item."""
    p = unclashed(docs, "k1", "k2")
    numbered = docs.select(F.lit(0).alias("doc"), F.col(text).alias("text"))
    dirty = (find_overlaps(numbered, benchmark, "doc", "text", **names)
             .select(F.col("k1").alias(p + "k1"), F.col("k2").alias(p + "k2")).distinct().checkpoint())
    k1, k2 = _key(F.col(text))
    return (docs.withColumns({p + "k1": k1, p + "k2": k2})
            .join(broadcast_if_small(dirty), [p + "k1", p + "k2"], "left_anti").select(*docs.columns))
