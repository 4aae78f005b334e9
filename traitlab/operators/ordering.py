"""Global order statistics without a single-partition window.

A window with an ``orderBy`` and no ``partitionBy`` moves every row into one
task. Both operators here range-partition instead, freeze the partitioning
with a reliable checkpoint (so a recomputation after an executor loss
cannot re-sample different range bounds), and stitch partitions together
with per-partition totals: one small row per partition, broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_dir

_PID = "_tl_pid"
_POS = "_tl_pos"


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return shuffle_width(df.sparkSession)


def shuffle_width(spark) -> int:
    """How wide shuffles start: AQE's initial width where it is set."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")),
               int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0))


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    n = _partitions(df, partitions)
    return (df.repartitionByRange(n, *order)
            .sortWithinPartitions(*order)
            .withColumn(_PID, F.spark_partition_id())
            .withColumn(_POS, F.monotonically_increasing_id())
            .checkpoint(eager=True))


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Exclusive prefix totals per partition id (one row per partition)."""
    per_part = ranged.groupBy(_PID).agg(*[s.alias(name) for name, s in sums.items()])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        _PID, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_off_{name}")
                for name in sums])


def global_index(df: DataFrame, order: Sequence[Column], index_col: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """Consecutive 0-based index along a total ``order`` (RNK-1).

    The order must be total (add a unique tie-breaker) or two runs may
    disagree. Cost: one range shuffle and a checkpoint write; the stitch
    join broadcasts one row per partition.
    """
    ranged = _ranged(df, order, partitions)
    offsets = _offsets(ranged, {"n": F.count(F.lit(1))})
    local = F.col(_POS) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out = (ranged.join(F.broadcast(offsets), _PID)
           .withColumn(index_col, (F.col("_off_n") + local).cast("long")))
    return out.drop(_PID, _POS, "_off_n")


def running_totals(df: DataFrame, order: Sequence[Column], columns: Sequence[str],
                   prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``columns`` along a total ``order``.

    Within a partition the sums come from a window partitioned by the range
    partition id, so no task holds more than one range of rows.
    """
    ranged = _ranged(df, order, partitions)
    offsets = _offsets(ranged, {c: F.sum(c) for c in columns})
    w = (Window.partitionBy(_PID).orderBy(_POS)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = ranged.join(F.broadcast(offsets), _PID)
    for c in columns:
        out = out.withColumn(prefix + c, F.col(f"_off_{c}") + F.sum(c).over(w))
    return out.drop(_PID, _POS, *[f"_off_{c}" for c in columns])
