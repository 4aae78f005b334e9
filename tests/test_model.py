from pyspark.sql import functions as F

from traitlab.operators import dataset as dsm
from traitlab.operators import metrics as met
from traitlab.operators import model as mdl
from traitlab.plans import pipelines as pipe
from traitlab.sources import sinks


def _doc_labelled(ctx):
    vectors = pipe.vectors_from(pipe.materialize(pipe.document_features(ctx)))
    ds = dsm.attach_labels(vectors, ctx.view("doc_labels"))
    return dsm.split_labelled(ds)


def test_learning_check_documents_quality(ctx01):
    labelled, _ = _doc_labelled(ctx01)
    res = mdl.build_model(labelled, 2, refine=True)
    assert res.report["auc"] > 0.6          # probability AUC on the fixed 20 % split
    assert 0.45 <= res.threshold <= 0.55 or res.threshold == 0.5
    assert res.model.getThreshold() == res.threshold


def test_multiclass_predictions_in_range_and_save_load(ctx001, scratch):
    vectors = pipe.vectors_from(pipe.materialize(ctx001.features))
    labels = pipe.known_labels(ctx001, "age")
    labelled, unlabelled = dsm.split_labelled(dsm.attach_labels(vectors, labels))
    res = mdl.build_model(labelled, 5, model_dir=scratch, name="age", job_date=20180709)
    assert res.model_path.endswith("/age/20180709")
    pred = mdl.predict(res.model, unlabelled)
    assert {r["label"] for r in pred.collect()} <= {0.0, 1.0, 2.0, 3.0, 4.0}
    again = sinks.load_logistic_model(res.model_path)
    a = sorted((r["device_id"], r["label"]) for r in pred.collect())
    b = sorted((r["device_id"], r["label"]) for r in mdl.predict(again, unlabelled).collect())
    assert a == b


def test_same_split_same_model(ctx001):
    labelled, _ = _doc_labelled(ctx001)
    m1 = mdl.build_model(labelled, 2).model
    m2 = mdl.build_model(labelled, 2).model
    assert m1.coefficients.toArray().tolist() == m2.coefficients.toArray().tolist()


def test_union_keeps_known_labels(spark):
    known = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "device_id string, label double")
    pred = spark.createDataFrame([("c", 1.0)], "device_id string, label double")
    u = {r["device_id"]: (r["label"], r["is_predicted"]) for r in mdl.union_known_predicted(known, pred).collect()}
    assert u == {"a": (1.0, False), "b": (0.0, False), "c": (1.0, True)}
    d = {r["label"]: r["n"] for r in met.confusion_counts(
        mdl.union_known_predicted(known, pred).withColumn("prediction", F.col("label"))).collect()}
    assert sum(d.values()) == 3


def test_holdout_and_seeded_split_options(ctx001):
    labelled, _ = _doc_labelled(ctx001)
    res = mdl.build_model(labelled, 2, refine=True, holdout_percent=10)
    assert res.threshold is not None and "refined_accuracy" in res.report
    a = mdl.build_model(labelled, 2, split_seed=42).model.coefficients.toArray().tolist()
    b = mdl.build_model(labelled, 2, split_seed=42).model.coefficients.toArray().tolist()
    assert a == b
