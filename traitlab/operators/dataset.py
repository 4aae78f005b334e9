"""Training data assembly (FEAT-7): features + known labels, splits, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as C
from .sizing import broadcast_if_small

UNKNOWN = -1.0


def attach_labels(features: DataFrame, labels: DataFrame, label_cols: list[str] | None = None,
                  max_broadcast_rows: int = C.BROADCAST_MAX_ROWS) -> DataFrame:
    """Left join per-device features with deduped labels (JOIN-2).

    A device without a label gets ``UNKNOWN``. The label side (one row per
    labelled device) is broadcast when a count proves it small; otherwise
    both sides shuffle on ``device_id`` (unique on both sides, so no hot
    key) and AQE may still split skewed partitions.
    """
    label_cols = label_cols or ["label"]
    side, _ = broadcast_if_small(labels.select("device_id", *label_cols), max_broadcast_rows)
    out = features.join(side, "device_id", "left")
    for c in label_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(UNKNOWN)))
    return out


def is_labelled(label: Column | str = "label") -> Column:
    col = F.col(label) if isinstance(label, str) else label
    return col != F.lit(UNKNOWN)


def split_labelled(ds: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled) rows (SPL-2)."""
    return ds.where(is_labelled(label)), ds.where(~is_labelled(label))


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """A stable bucket in [0, buckets) from md5 of the key text.

    Reproducible across runs, engines and recomputations, unlike an
    unseeded random split.
    """
    col = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long"),
                  F.lit(buckets))


def in_train(key: Column | str = "device_id", train_percent: int = C.TRAIN_PERCENT) -> Column:
    return hash_bucket(key) < train_percent


def split_train_valid(labelled: DataFrame, key: str = "device_id",
                      train_percent: int = C.TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """80 / 20 split on a hash of the device id (SPL-1)."""
    flag = in_train(key, train_percent)
    return labelled.where(flag), labelled.where(~flag)


def counts(ds: DataFrame, label: str = "label", key: str = "device_id",
           train_percent: int = C.TRAIN_PERCENT) -> DataFrame:
    """Dataset sizes in one aggregate (AGG-5)."""
    lab = is_labelled(label)
    train = in_train(key, train_percent)
    return ds.agg(F.count(F.lit(1)).alias("n_total"),
                  F.count_if(lab).alias("n_labelled"),
                  F.count_if(~lab).alias("n_unlabelled"),
                  F.count_if(lab & train).alias("n_train"),
                  F.count_if(lab & ~train).alias("n_valid"))
