"""Published tables: dated partitions that readers see whole or not at all.

``PATH/_runs/RUN/`` holds what one run wrote, partitioned as usual, and
``PATH/_manifest/v000000000012`` names, for every partition, the runs whose rows
it consists of, with their row counts. Writing fills the run's folder only; its
rows are counted against those to be written, and one rename then
puts a new manifest version in place. Until that rename readers follow the
version before, so a job that dies half-way, or a task that leaves files behind,
is never seen, and a partition is replaced in one step however many files it has.

A manifest version is claimed by a rename that fails where the name is taken;
the loser reads the winner's version and tries again on top of it. Appending a
run that a partition already has changes nothing, so a repeated append is safe;
another run id adds its rows. A published run id cannot replace itself.

The driver handles manifests only: one entry per partition and run.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .sinks import _shape


class PublishError(RuntimeError):
    """The written rows are not the rows that were to be written."""


class _Store:
    """The few file-system calls of manifests, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.sc, self.root = spark.sparkContext, path.rstrip("/")
        self.hadoop = self.sc._jvm.org.apache.hadoop.fs
        self.conf = self.sc._jsc.hadoopConfiguration()
        self.fs = self.hadoop.Path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def claim(self, source: str, target: str) -> bool:
        """Rename, or False where the target exists."""
        files = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        keep = self.sc._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            files.rename(self.path(source), self.path(target), keep)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            self.delete(source)
            return False

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _versions(store: _Store) -> list[str]:
    return sorted(n for n in store.names("_manifest") if re.fullmatch(r"v\d{12}", n))


def _current(store: _Store) -> tuple[int, dict]:
    """Number and content of the newest manifest."""
    found = _versions(store)
    if not found:
        return 0, {"columns": [], "schema": None, "partitions": []}
    return int(found[-1][1:]), json.loads(store.read(f"_manifest/{found[-1]}"))


def _key(columns: Sequence[str], row) -> list:
    return [None if row[c] is None else str(row[c]) for c in columns]


def stage(df: DataFrame, path: str, run_id: str, partition_cols: Sequence[str] = ("stat_date",),
          files: int | None = None, published: Sequence[list] = ()) -> list[tuple[list, int]]:
    """Write a run's rows where no reader looks, and count them:
    (partition values, rows) of every partition written. The rows to be written
    are counted by a second, column-pruned pass over the plan.

    ``published`` are partitions that the run already has; their rows are left out.
    """
    spark, store = df.sparkSession, _Store(df.sparkSession, path)
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    folder = f"_runs/{run_id}"
    if not published:
        store.delete(folder)                 # what an attempt that died has left
    for values in published:
        same = F.lit(True)
        for c, v in zip(partition_cols, values, strict=True):
            same = same & F.col(c).cast("string").eqNullSafe(F.lit(v))
        df = df.where(~same)
    (_shape(df, files, partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(f"{store.root}/{folder}"))
    if not any("=" in n for n in store.names(folder)):
        rows = []
    else:
        back = spark.read.schema(df.schema).parquet(f"{store.root}/{folder}")
        rows = [(_key(partition_cols, r), r["n"]) for r in
                back.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n")).collect()]
        rows = [(values, n) for values, n in rows if values not in list(published)]
    total, expected = sum(n for _, n in rows), df.count()
    if total != expected:
        raise PublishError(f"{total} of {expected} rows written by run {run_id} of {path}")
    return rows


def publish(df: DataFrame, path: str, run_id: str, partition_cols: Sequence[str] = ("stat_date",),
            append: bool = False, files: int | None = None) -> list[tuple[list, int]]:
    """Write ``df`` as run ``run_id`` and make it what readers see (SNK-1..3).

    Replaces the partitions that ``df`` has rows of, or adds to them with
    ``append``. Returns (partition values, rows) of what is new.
    """
    store = _Store(df.sparkSession, path)
    _, manifest = _current(store)
    mine = [p["values"] for p in manifest["partitions"] if any(r["run"] == run_id for r in p["runs"])]
    if mine and not append:
        raise ValueError(f"run {run_id} of {path} is published; replace it under another run id")
    new = stage(df, path, run_id, partition_cols, files, mine)
    while new:
        number, manifest = _current(store)
        if manifest["columns"] not in ([], list(partition_cols)):
            raise ValueError(f"{path} is partitioned by {manifest['columns']}")
        held = {json.dumps(p["values"]): p["runs"] for p in manifest["partitions"]}
        for values, n in new:
            key = json.dumps(values)
            before = [r for r in held.get(key, []) if r["run"] != run_id] if append else []
            held[key] = [*before, {"run": run_id, "rows": n}]
        text = json.dumps({"columns": list(partition_cols), "schema": df.schema.jsonValue(),
                           "partitions": [{"values": json.loads(k), "runs": v} for k, v in sorted(held.items())]})
        draft = f"_manifest/.{uuid.uuid4().hex}"
        store.write(draft, text)
        if store.claim(draft, f"_manifest/v{number + 1:012d}"):
            break
    return new


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_versions(_Store(spark, path)))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest manifest, with the partition columns last."""
    store = _Store(spark, path)
    number, manifest = _current(store)
    if not number:
        raise ValueError(f"nothing is published at {path}")
    schema = T.StructType.fromJson(manifest["schema"])
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folders: dict[str, list[str]] = {}
    for p in manifest["partitions"]:
        place = "/".join(catalog.getPartitionPathString(c, v) for c, v in zip(manifest["columns"], p["values"], strict=True))
        for r in p["runs"]:
            folders.setdefault(r["run"], []).append(f"{store.root}/_runs/{r['run']}/{place}")
    out = None
    for run, places in sorted(folders.items()):
        rows = spark.read.schema(schema).option("basePath", f"{store.root}/_runs/{run}").parquet(*places)
        out = rows if out is None else out.unionByName(rows)
    return out


def prune(spark: SparkSession, path: str) -> list[str]:
    """Delete the runs that the newest manifest does not name (replaced ones and
    those of dead attempts), and older manifests. Not while others write or read."""
    store = _Store(spark, path)
    _, manifest = _current(store)
    used = {r["run"] for p in manifest["partitions"] for r in p["runs"]}
    gone = [n for n in store.names("_runs") if n not in used]
    for n in gone:
        store.delete(f"_runs/{n}")
    for v in _versions(store)[:-1]:
        store.delete(f"_manifest/{v}")
    return gone
