"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "traitlab",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session tuned for the attribute jobs.

    AQE re-plans joins from runtime sizes, coalesces small shuffle outputs and
    splits skewed partitions; dynamic partition overwrite keeps other dates of
    a dated table intact. On a cluster pass ``master=None`` and let
    spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of intermediates are removed once nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not _is_local(spark) and not shuffle_partitions:
        apply_cluster_shuffle_defaults(spark)
    return spark


def apply_cluster_shuffle_defaults(spark: SparkSession) -> dict[str, str]:
    """Size shuffles for cluster-scale inputs unless the job configured them.

    Every shuffle starts with ``CLUSTER_INITIAL_SHUFFLE_PARTITIONS`` and AQE
    coalesces contiguous small partitions to the advisory size, so reducers
    get partitions that fit in memory at any input size (Spark's default of
    200 would mean hundreds of GB per reducer at 100 TB). Keys set at launch
    or earlier in the session are left alone. Returns what was set.
    """
    from .constants import CLUSTER_ADVISORY_PARTITION_BYTES, CLUSTER_INITIAL_SHUFFLE_PARTITIONS
    launch = spark.sparkContext.getConf()
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum":
            str(CLUSTER_INITIAL_SHUFFLE_PARTITIONS),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": CLUSTER_ADVISORY_PARTITION_BYTES,
    }
    if launch.contains("spark.sql.shuffle.partitions"):
        return {}
    applied = {}
    for key, value in wanted.items():
        if not launch.contains(key) and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints, read from the session.

    ``spark.checkpoint.dir`` names the cluster's shared folder. Only a local
    session without that setting (tests) gets a private scratch folder; a
    cluster session without it is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="traitlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else \
        base.rstrip("/") + "/tables/" + name


def delete_on_exit(spark: SparkSession, path: str) -> str:
    """Have the file system delete ``path`` when the application ends."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def remove_scratch_tables(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables (``<checkpoint dir>/tables``).

    Checkpoint files are cleaned by Spark once unreferenced; the Parquet
    intermediates are not, so a job removes them when its outputs are
    written. Returns whether anything was deleted.
    """
    if not spark.sparkContext.getCheckpointDir():
        return False
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.delete(path, True))
