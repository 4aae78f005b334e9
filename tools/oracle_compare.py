"""Compare registered Spark queries with their DuckDB oracle statements.

Mirrors the test driver: row count, column names, and the multiset of rows
with columns sorted by name.
"""

from __future__ import annotations

import math
import time

import duckdb

from traitlab.sources.tables import DRIVER_TABLES


def _norm(v):
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
          "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, queries: dict, oracle: dict, names=None):
    """Yield (name, status, detail) with status OK / FAIL / ROWS (no oracle)."""
    con = duck(sf_dir)
    for name, fn in queries.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            cols = sorted(sdf.columns)
            stypes = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                      for f in sdf.schema.fields}
            srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
        except Exception as e:  # noqa: BLE001
            yield name, "FAIL", f"spark error {type(e).__name__}: {str(e)[:400]}"
            continue
        took = time.time() - t0
        if name not in oracle:
            yield name, "ROWS", f"{len(srows)} rows ({took:.1f}s)"
            continue
        try:
            rel = con.sql(oracle[name])
            dcols = sorted(rel.columns)
            dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            idx = [rel.columns.index(c) for c in dcols]
            drows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
        except Exception as e:  # noqa: BLE001
            yield name, "FAIL", f"duckdb error {type(e).__name__}: {str(e)[:400]}"
            continue
        if cols != dcols:
            yield name, "FAIL", f"columns {cols} vs {dcols}"
        elif any(stypes[c] != dtypes[c] for c in cols):
            yield name, "FAIL", f"types {stypes} vs {dtypes}"
        elif srows != drows:
            ds, ss = set(drows), set(srows)
            yield name, "FAIL", (f"rows {len(srows)} vs {len(drows)}; spark-only "
                                 f"{[r for r in srows if r not in ds][:3]}; duck-only "
                                 f"{[r for r in drows if r not in ss][:3]}")
        else:
            yield name, "OK", f"{len(srows)} rows ({took:.1f}s)"
