"""Results must not depend on how many partitions the cluster uses."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["catalog_index", "features_encoded", "labels_long", "f1_by_threshold",
         "split_train_valid", "doc_features", "label_matrix"]


def _rows(spark, name, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = E.queries()[name](spark, SF)
        cols = sorted(df.columns)
        return sorted(tuple(r[c] for c in cols) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_any_partition_count(spark, name):
    assert _rows(spark, name, 1) == _rows(spark, name, 11)
