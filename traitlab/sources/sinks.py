"""Writers: dated partition overwrite, append, and model storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _shape(df: DataFrame, files: int | None, partition_cols: Sequence[str]) -> DataFrame:
    if files:
        # A fixed file count per written partition, as the original jobs did.
        return df.repartition(files)
    # Let AQE size the files: REBALANCE splits skewed and merges tiny
    # partitions at the advisory size instead of a fixed count, which would
    # create huge files at cluster scale.
    if partition_cols:
        return df.hint("rebalance", *partition_cols)
    return df.hint("rebalance")


def overwrite_partitions(df: DataFrame, path: str,
                         partition_cols: Sequence[str] = ("stat_date",),
                         files: int | None = None, fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df`` (SNK-1/SNK-3).

    Dynamic overwrite keeps every other date (and attribute) in place, so a
    re-run of one day is idempotent. The target is created if absent.
    """
    (_shape(df, files, partition_cols).write.format(fmt)
     .mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .save(path))


def bucketed_table(df: DataFrame, table: str, key: str, buckets: int,
                   partition_cols: Sequence[str] = ("stat_date",), path: str | None = None) -> None:
    """Replace the dates of ``df`` in a table bucketed and sorted by ``key``.

    Rows are dealt by the key's hash as the buckets are, so every bucket of a
    date is one sorted file, and joins on the key with another side dealt into
    ``buckets`` need no exchange of this table. The table is created if absent.
    """
    spark = df.sparkSession
    rows = df.repartition(buckets, key)
    if spark.catalog.tableExists(table):
        order = spark.table(table).columns
        rows.select(*order).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
        return
    writer = rows.write.format("parquet").partitionBy(*partition_cols).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_partitions(df: DataFrame, path: str,
                      partition_cols: Sequence[str] = ("stat_date",),
                      files: int | None = None, fmt: str = "parquet") -> None:
    """Append (SNK-2). A re-run duplicates the date; prefer overwrite."""
    (_shape(df, files, partition_cols).write.format(fmt)
     .mode("append").partitionBy(*partition_cols).save(path))


def model_path(model_dir: str, name: str, job_date: int) -> str:
    return f"{model_dir.rstrip('/')}/{name}/{job_date}"


def save_model(model, model_dir: str, name: str, job_date: int) -> str:
    """Save under ``<dir>/<name>/<date>``, replacing an older copy (SNK-5)."""
    path = model_path(model_dir, name, job_date)
    model.write().overwrite().save(path)
    return path


def load_logistic_model(path: str):
    from pyspark.ml.classification import LogisticRegressionModel
    return LogisticRegressionModel.load(path)
