from pyspark.sql import functions as F

from traitlab.operators import dataset as dsm


def test_attach_labels_marks_unknown(spark):
    feats = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "device_id string, x int")
    labels = spark.createDataFrame([("a", 1.0), ("z", 0.0)], "device_id string, label double")
    for bound in (10, 0):  # broadcast and shuffle join paths
        got = {r["device_id"]: r["label"] for r in dsm.attach_labels(feats, labels, max_broadcast_rows=bound).collect()}
        assert got == {"a": 1.0, "b": -1.0, "c": -1.0}


def test_hash_split_is_stable_and_near_80_20(spark):
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("device_id"))
    tr1, va1 = dsm.split_train_valid(df)
    tr2, _ = dsm.split_train_valid(df.repartition(7))
    assert tr1.count() + va1.count() == 20000
    assert sorted(r[0] for r in tr1.collect()) == sorted(r[0] for r in tr2.collect())
    assert 0.78 < tr1.count() / 20000 < 0.82


def test_counts(spark):
    ds = spark.createDataFrame([(str(i), 1.0 if i % 3 else -1.0) for i in range(300)],
                               "device_id string, label double")
    c = dsm.counts(ds).first()
    assert c["n_total"] == 300 and c["n_labelled"] == 200 and c["n_unlabelled"] == 100
    assert c["n_train"] + c["n_valid"] == 200
