import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from traitlab.operators import metrics as met


def _brute(scores_labels):
    """Exact threshold metrics by brute force, with ties grouped."""
    P = sum(1 for _, l in scores_labels if l > 0.5)
    N = len(scores_labels) - P
    pts, f1 = [(0.0, 0.0)], {}
    for t in sorted({s for s, _ in scores_labels}, reverse=True):
        tp = sum(1 for s, l in scores_labels if s >= t and l > 0.5)
        fp = sum(1 for s, l in scores_labels if s >= t and l <= 0.5)
        pts.append((fp / N, tp / P))
        p, r = tp / (tp + fp), tp / P
        f1[t] = 0.0 if p + r == 0 else 2 * p * r / (p + r)
    pts.append((1.0, 1.0))
    auc = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    return pts, auc, f1


def _scored(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = 1.0 if rnd.random() < 0.4 else 0.0
        score = round(min(1.0, max(0.0, rnd.gauss(0.6 if label else 0.4, 0.2))), 2)
        rows.append((i, score, label))
    return rows, spark.createDataFrame(rows, "id long, score double, label double").repartition(5)


def test_roc_auc_f1_match_brute_force(spark):
    rows, df = _scored(spark)
    pts, auc, f1 = _brute([(s, l) for _, s, l in rows])
    got_pts = sorted((r["fpr"], r["tpr"]) for r in met.roc_curve(df).collect())
    assert len(got_pts) == len(pts)
    for (a, b), (c, d) in zip(got_pts, sorted(pts)):
        assert abs(a - c) < 1e-12 and abs(b - d) < 1e-12
    assert abs(met.auc(df).first()["auc"] - auc) < 1e-12
    got_f1 = {r["threshold"]: r["f1"] for r in met.f1_by_threshold(df).collect()}
    assert got_f1.keys() == f1.keys()
    assert all(abs(got_f1[t] - f1[t]) < 1e-12 for t in f1)


def test_auc_matches_ml_evaluator(spark):
    _, df = _scored(spark, 600, seed=3)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    assert abs(ev.evaluate(df) - met.auc(df).first()["auc"]) < 1e-9


def test_best_threshold_ties_take_higher_threshold(spark):
    f1 = spark.createDataFrame([(0.3, 0.8), (0.6, 0.8), (0.9, 0.1)], "threshold double, f1 double")
    b = met.best_threshold(f1).first()
    assert (b["threshold"], b["f1"]) == (0.6, 0.8)


def test_refined_threshold_window(spark):
    # all positives above 0.52, negatives below: F1-best threshold 0.52 lies in [0.45, 0.55]
    rows = [(i, 0.52 + (i % 3) / 100, 1.0) for i in range(10)] + \
           [(100 + i, 0.2 + (i % 3) / 100, 0.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, score double, label double")
    r = met.refined_threshold(df).first()
    assert r["best_threshold"] == 0.52 and r["threshold"] == 0.52
    far = df.withColumn("score", F.col("score") / 4)
    r = met.refined_threshold(far).first()
    assert r["threshold"] == 0.5 and r["best_threshold"] == 0.13


def test_per_class_and_confusion(spark):
    rows = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(2.0, 0.0)] + [(2.0, 2.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    cm = {(r["label"], r["prediction"]): r["n"] for r in met.confusion_counts(df).collect()}
    assert cm == {(0.0, 0.0): 3, (0.0, 1.0): 1, (1.0, 1.0): 2, (2.0, 0.0): 1, (2.0, 2.0): 1}
    pc = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in met.per_class_metrics(df).collect()}
    assert pc[0.0][0] == 3 / 4 and pc[0.0][1] == 3 / 4
    assert pc[1.0][0] == 2 / 3 and pc[1.0][1] == 1.0
    assert pc[2.0][0] == 1.0 and pc[2.0][1] == 1 / 2
    assert abs(met.accuracy(df).first()["accuracy"] - 6 / 8) < 1e-15


def test_hard_auc_is_balanced_accuracy(spark):
    rows = [(1.0, 1.0)] * 6 + [(0.0, 1.0)] * 2 + [(1.0, 0.0)] * 3 + [(0.0, 0.0)] * 9
    df = spark.createDataFrame(rows, "prediction double, label double")
    tpr, tnr = 6 / 8, 9 / 12
    assert abs(met.hard_auc(df).first()["auc"] - (tpr + tnr) / 2) < 1e-12


def test_hard_auc_equals_curve_auc(spark):
    rows = [(float(i % 2), float((i // 3) % 2)) for i in range(97)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    assert met.hard_auc(df).first()["auc"] == met.auc(df, "prediction").first()["auc"]
    ones = df.withColumn("prediction", F.lit(1.0))
    assert met.hard_auc(ones).first()["auc"] == met.auc(ones, "prediction").first()["auc"] == 0.5


def test_per_class_matches_ml_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(11)
    rows = [(float(rnd.randrange(3)), float(rnd.randrange(3))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = {r["label"]: r for r in met.per_class_metrics(df).collect()}
    for k in (0.0, 1.0, 2.0):
        for metric, col in (("precisionByLabel", "precision"), ("recallByLabel", "recall"),
                            ("fMeasureByLabel", "f1")):
            ev = MulticlassClassificationEvaluator(metricName=metric, metricLabel=k)
            assert abs(ev.evaluate(df) - ours[k][col]) < 1e-12, (k, metric)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert abs(acc - met.accuracy(df).first()["accuracy"]) < 1e-12


def test_summaries_equal_single_metrics(spark):
    _, df = _scored(spark, 300, seed=5)
    curve = met.ThresholdCurve(df)
    s = curve.summary()
    assert s["auc"] == met.auc(df).first()["auc"]
    b = met.best_threshold(met.f1_by_threshold(df)).first()
    assert (s["best_threshold"], s["best_f1"]) == (b["threshold"], b["f1"])
    hard = df.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))
    h = met.hard_summary(hard)
    assert h["accuracy"] == met.accuracy(hard).first()["accuracy"]
    assert h["auc_hard"] == met.hard_auc(hard).first()["auc"]
