"""Dated snapshot scans.

Every input of the jobs is a daily snapshot keyed by an integer
``stat_date`` (yyyyMMdd). Filtering on it first lets Catalyst prune date
partitions (``PartitionFilters``) on partitioned tables and push the
predicate into the parquet reader (``PushedFilters``) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dated_scan(df: DataFrame, job_date: int | None, columns: Sequence[str],
               date_col: str = "stat_date") -> DataFrame:
    """``select columns where stat_date = job_date`` (SRC-1).

    ``job_date=None`` reads an undated table (SRC-2).
    """
    if job_date is not None:
        df = df.where(F.col(date_col) == F.lit(int(job_date)))
    return df.select(*columns)


def by_position(df: DataFrame, positions: dict[int, str]) -> DataFrame:
    """Name columns of a ``select *`` read by their position (SRC-3)."""
    cols = df.columns
    return df.select(*[F.col(cols[i]).alias(name) for i, name in positions.items()])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose listed columns are all present (FLT-1)."""
    return df.dropna(subset=list(columns))


def answered(df: DataFrame, column: str) -> DataFrame:
    """Rows whose answer is non-empty text (FLT-2); null never passes ``!=``."""
    return df.where(F.col(column) != F.lit(""))


def via_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view and read it back by SQL (SRC-5)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"select * from {name}")
