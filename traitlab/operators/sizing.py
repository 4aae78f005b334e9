"""Size checks that gate broadcasts and single-task steps.

A side is broadcast only when its counted rows and the bytes of its
variable-length columns stay below fixed bounds. The check is one aggregate
(two numbers per task reach one row). Callers persist or checkpoint the side
first so the proof and the join see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import constants as C


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes): strings by their length, other columns as eight bytes."""
    size = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return rows, total


def small(df: DataFrame, max_rows: int = C.BROADCAST_MAX_ROWS,
          max_bytes: int = C.BROADCAST_MAX_BYTES) -> bool:
    rows, total = measured(df)
    return rows <= max_rows and total <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = C.BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when ``df`` stays below both bounds.

    Otherwise ``(df, False)``: the caller keeps a shuffle join, which AQE may
    still turn into a broadcast from runtime sizes or split when skewed.
    """
    if small(df, max_rows):
        return F.broadcast(df), True
    return df, False
