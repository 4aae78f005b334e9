"""Driver tables: one parquet file per table under an sf directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Tables whose rows carry heavy per-row work (long texts to tokenize).
SPREAD_TABLES = ("documents",)


class TableSet:
    """Lazily opened parquet tables of one scale factor.

    Reads are plain ``spark.read.parquet`` scans, so column pruning and
    filter pushdown reach the files through Catalyst. A table listed in
    ``spread`` whose scan yields fewer splits than the session's default
    parallelism (one large file, one row group) is round-robin
    repartitioned right after the scan, so the per-row work that follows
    uses every core; with many input files (a cluster) nothing changes.
    """

    def __init__(self, spark: SparkSession, sf_dir: str,
                 spread: tuple[str, ...] = SPREAD_TABLES):
        self.spark = spark
        self.sf_dir = sf_dir
        self.spread = spread
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.read.parquet(self.path(name))
            if name in self.spread:
                want = self.spark.sparkContext.defaultParallelism
                if df.rdd.getNumPartitions() < want:
                    df = df.repartition(want)
            self._cache[name] = df
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)
