"""Helpers shared by the corpus operators: text expressions, shared-folder
tables, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Characters that separate words: space and U+0009 to U+000D.
SPACES = "[ \\t-\\r]+"
# A side is broadcast only below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character kept (``lower`` would also change
    non-ASCII letters)."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of the words between white space; null text gives no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


# Scratch paths of this process that have not been released yet.
_SCRATCH: list[str] = []


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_file(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, deleted when it is
    released or the application ends."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    hadoop_path, fs = _file_system(spark, path)
    fs.deleteOnExit(hadoop_path)
    _SCRATCH.append(path)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and reread it.

    Later jobs read the written rows instead of recomputing them, also after
    executors are lost.
    """
    path = scratch_file(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_paths() -> set[str]:
    """The scratch tables that exist now."""
    return set(_SCRATCH)


def release_scratch(spark: SparkSession, paths: set[str]) -> None:
    """Delete scratch tables, once all results that read them are written."""
    for path in paths.intersection(_SCRATCH):
        hadoop_path, fs = _file_system(spark, path)
        fs.delete(hadoop_path, True)
        _SCRATCH.remove(path)


def small_enough(df: DataFrame, *text_columns: str) -> bool:
    """Whether ``df`` (already materialised) stays below the broadcast bounds,
    counting the bytes of the named variable-length columns."""
    size = F.lit(0)
    for c in text_columns:
        size = size + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
    rows, extra = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and extra + rows * 16 * len(df.columns) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, *text_columns: str) -> DataFrame:
    """A broadcast hint only when the measured size allows it; otherwise the
    plain frame, joined by shuffle with AQE splitting skewed keys."""
    return F.broadcast(df) if small_enough(df, *text_columns) else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that are called like ``names`` renamed, and how
    to rename them back."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    prefix = unclashed(df, *clash) + "own" if clash else ""
    return df.withColumnsRenamed({c: prefix + c for c in clash}), {prefix + c: c for c in clash}


def unclashed(df: DataFrame, *names: str) -> str:
    """A column name prefix under which none of ``names`` exists in ``df``."""
    prefix = "_"
    while any((prefix + n).lower() in {c.lower() for c in df.columns} for n in names):
        prefix += "_"
    return prefix
