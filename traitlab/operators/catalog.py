"""Item catalog: max-install dedup, global rank index, top-K (FEAT-1).

The catalog lists items with install counts, several rows per item and day.
An item keeps its row with the most installs (ties: smallest name), items
are ordered by installs descending with the item id as tie-breaker, and the
position in that order is the item's feature index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import constants as C
from ..sources.snapshot import dated_scan, not_null
from ..session import checkpoint_dir
from .ordering import global_index, shuffle_width


def catalog_order() -> tuple:
    """Installs descending, then item id: a total order."""
    return (F.col("installnum").desc(), F.col("appid").asc())


def catalog_rows(catalog: DataFrame, job_date: int | None) -> DataFrame:
    """Dated scan of (appid, app_name, installnum) without nulls (SRC-1, FLT-1)."""
    rows = dated_scan(catalog, job_date, ["appid", "app_name", "installnum"])
    return not_null(rows, "appid", "app_name", "installnum")


def keep_max_installs(rows: DataFrame) -> DataFrame:
    """One row per item: most installs, then smallest name (AGG-2).

    ``min`` over a (-installs, name) struct is a plain aggregate with a
    map-side partial step, so a hot item costs one partial row per task.
    """
    best = F.min(F.struct((-F.col("installnum")).alias("neg"), F.col("app_name").alias("name")))
    return (rows.groupBy("appid").agg(best.alias("b"))
            .select("appid", F.col("b.name").alias("app_name"),
                    (-F.col("b.neg")).alias("installnum")))


def rank_catalog(dedup: DataFrame, partitions: int | None = None) -> DataFrame:
    """(appid, app_name, installnum, idx) with idx 0.. along the catalog order (RNK-1)."""
    return global_index(dedup, catalog_order(), "idx", partitions)


def cut_off(rows: DataFrame, k: int, column: str = "installnum", buckets: int = C.HISTOGRAM_BUCKETS) -> int | None:
    """A whole number that at least ``min(k, rows)`` rows reach, and few more.

    A histogram of the column (one aggregate to at most ``buckets`` rows) finds
    the bucket that holds the k-th largest value; the same within that bucket
    narrows it, until the rows reaching it are fewer than 2 k or share one value.
    """
    value = F.floor(F.col(column)).cast("long")
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None:
        return None
    above = 0
    while True:
        width = (high - low) // buckets + 1
        counts = (rows.where(value.between(low, high))
                  .groupBy(F.floor((value - low) / width).cast("int").alias("b")).count().collect())
        for r in sorted(counts, key=lambda r: -r["b"]):
            if above + r["count"] >= k or r["b"] == min(c["b"] for c in counts):
                break
            above += r["count"]
        low, high = low + r["b"] * width, min(high, low + (r["b"] + 1) * width - 1)
        if width == 1 or above + r["count"] <= 2 * k:
            return low


def top_k(dedup: DataFrame, k: int, max_merge_rows: int = C.TOPK_MAX_MERGE_ROWS,
          ranked: DataFrame | None = None) -> DataFrame:
    """The k most installed items with their rank index (RNK-2).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its own k best rows and one task merges them, at most
    ``partitions * k`` rows. That is used only while this product is within
    ``max_merge_rows``. Otherwise a histogram finds the cut-off value, and only
    rows that reach it are range-sorted for the index; the rest of the catalog
    never shuffles. With the ranked catalog at hand, its rows below k are taken.
    """
    if ranked is not None:
        return ranked.where(F.col("idx") < k)
    parts = shuffle_width(dedup.sparkSession)
    if parts * k <= max_merge_rows:
        best = dedup.orderBy(*catalog_order()).limit(k)
        w = Window.orderBy(*catalog_order())
        return best.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))
    checkpoint_dir(dedup.sparkSession)
    rows = dedup.checkpoint()
    least = cut_off(rows, k)
    return rank_catalog(rows.where(F.col("installnum") >= (least or 0))).where(F.col("idx") < k)


def lookup_table(ranked: DataFrame, prefix: str = "") -> DataFrame:
    """Lookup side of the install join: key, index and the encoded token.

    The token text (see ``constants``: ``[key_name]`` marker ``idx:1``) is built once per item here
    rather than once per (device, item) pair after the join.
    """
    key = F.concat(F.lit(prefix), F.col("appid"))
    token = F.concat(F.lit(C.TOKEN_OPEN), key, F.lit(C.TOKEN_NAME_SEP), F.col("app_name"),
                     F.lit(C.TOKEN_INDEX_SEP), F.col("idx").cast("string"),
                     F.lit(C.VALUE_SEP + "1"))
    return ranked.select(key.alias("key"), F.col("idx"), token.alias("token"))
