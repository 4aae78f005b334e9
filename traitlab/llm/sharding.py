"""Uniform shuffle into shards of exact sizes by a communication matrix.

1. Each input partition is permuted locally (a sort by a hash of the row's
   position, no exchange) and written with its partition number and the rank.
2. From the partition sizes, the matrix of partition-to-shard counts is drawn
   from the multivariate hypergeometric law: exactly the counts that a uniform
   permutation of all rows would give, with row sums equal to the partition
   sizes and column sums equal to the shard sizes, which differ by at most one.
3. A partition's first ranks go to shard 0, the next to shard 1, and so on.
4. Rows are exchanged and permuted again within the shard, in hash buckets
   whose offsets make the slots gapless, so no task holds a whole shard.

The driver sees one count per input partition; the matrix has partitions x
shards numbers and is broadcast only below a checked size. The seed and the
input partitioning fix the result; rows equal in all columns are shuffled like
any others because their positions differ.

Defined results: any column may be null or have any type or name (``shard``
and ``slot`` of the input are replaced); an empty table gives no rows; with
fewer rows than shards the first shards have one row each.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import broadcast_if_small, scratch_table, unclashed

ROWS_PER_BUCKET = 100_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One exact draw by inversion around the mode, for populations of any size.

    The probabilities of neighbouring counts differ by a rational factor, so
    their logarithms are summed outwards from the mode as far as 14 standard
    deviations, beyond which less than 1e-40 of the mass lies.
    """
    low, high = max(0, sample - bad), min(sample, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((sample + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    sd = math.sqrt(sample * share * (1 - share) * (total - sample) / max(total - 1, 1))
    reach = int(14 * sd) + 40
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    steps = (np.log(good - k) + np.log(sample - k)
             - np.log(k + 1) - np.log(bad - sample + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(mass, rng.random() * mass[-1], "right"))


def communication_matrix(sizes: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Counts by source (rows, sums ``sizes``) and shard (columns, sums ``shards``)."""
    rng, left, matrix = np.random.default_rng(seed), list(shards), []
    for size in sizes:
        row, bad = [], sum(left)
        for k, good in enumerate(left):
            bad -= good
            n = draw_hypergeometric(rng, good, bad, size)
            row.append(n)
            left[k] -= n
            size -= n
        matrix.append(row)
    return matrix


def shuffle(df: DataFrame, shards: int = 8, seed: int = 20240229) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    df = df.drop("shard", "slot")
    spark = df.sparkSession
    names = ("source", "rank", "key", "bucket", "ends", "before")
    p = unclashed(df, *names)
    source, rank, key, bucket, ends, before = (p + n for n in names)
    placed = df.withColumn(rank, F.monotonically_increasing_id())
    placed = placed.withColumns({source: F.spark_partition_id(),
                                 key: F.xxhash64(F.lit(seed), rank)})
    # after the local sort the running number within the partition is the rank
    local = (placed.sortWithinPartitions(key)
             .withColumns({rank: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
                           key: F.xxhash64(F.lit(seed + 1), key)}))
    local = scratch_table(local, "shuffle")
    sizes = sorted((r[0], r[1]) for r in local.groupBy(source).count().collect())
    rows = sum(n for _, n in sizes)
    matrix = communication_matrix([n for _, n in sizes], shard_sizes(rows, shards), seed)
    table = [{"s": s, "e": np.cumsum(row).tolist()} for (s, _), row in zip(sizes, matrix, strict=True)]
    cuts = (spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(table)), "array<struct<s:int,e:array<bigint>>>")).alias("c"))
        .select(F.col("c.s").alias(source), F.col("c.e").alias(ends)))
    buckets = max(8, rows // (ROWS_PER_BUCKET * shards))
    small = len(sizes) * shards * 8 <= 32 << 20
    sent = (local.join(F.broadcast(cuts) if small else cuts, source)
            .withColumns({"shard": F.size(F.filter(ends, lambda e: e <= F.col(rank))),
                          bucket: F.pmod(F.col(key), F.lit(buckets)).cast("int")})
            .drop(source, rank, ends))
    # shards x buckets rows: one for a hundred thousand of the input
    inside = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sent.groupBy("shard", bucket).count()
               .select("shard", bucket, F.coalesce(F.sum("count").over(inside), F.lit(0)).alias(before)))
    offsets = broadcast_if_small(offsets.checkpoint())
    order = Window.partitionBy("shard", bucket).orderBy(key)
    return (sent.withColumn("slot", F.row_number().over(order))
            .join(offsets, ["shard", bucket])
            .withColumn("slot", (F.col("slot") - 1 + F.col(before)).cast("long"))
            .select(*df.columns, "shard", "slot"))


def write_shards(df: DataFrame, path: str, shards: int = 8, seed: int = 20240229) -> None:
    """Write the shuffled rows under ``shard=k`` folders, in slot order."""
    (shuffle(df, shards, seed).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
