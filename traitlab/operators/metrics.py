"""Evaluation of scored devices (EVAL-1..6, RNK-4, ML-4).

Threshold metrics follow the exact (unbinned) definitions: every distinct
score is a threshold, a device is positive at threshold t when its score
is >= t, and a label above 0.5 is positive. Scores are first grouped
(partial aggregation), then cumulated along descending score with the
range-partitioned running totals, so no step needs one task to hold all
scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from .ordering import running_totals


def _positive(label: str) -> F.Column:
    return F.col(label) > F.lit(0.5)


def score_counts(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, tp, fp): positives and negatives per distinct score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(_positive(label)).alias("tp"), F.count_if(~_positive(label)).alias("fp"))


def f1_of(cum_tp: str, cum_fp: str, positives) -> F.Column:
    """F1 of the rows at or above a threshold, among ``positives`` in all."""
    precision = F.col(cum_tp) / (F.col(cum_tp) + F.col(cum_fp))
    recall = F.coalesce(F.try_divide(F.col(cum_tp), positives), F.lit(0.0))
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * precision * recall / (precision + recall))


class ThresholdCurve:
    """Cumulative counts along descending score, computed once and shared by
    the ROC points, the AUC and the F1 curve of one scored set."""

    def __init__(self, scored: DataFrame, score: str = "score", label: str = "label"):
        counts = score_counts(scored, score, label)
        # (score, tp, fp, cum_tp, cum_fp); checkpointed inside running_totals
        self.cum = running_totals(counts, [F.col("score").desc()], ["tp", "fp"])
        totals = self.cum.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n")).first()
        self.p, self.n = int(totals["p"] or 0), int(totals["n"] or 0)
        self.spark = scored.sparkSession

    def roc(self) -> DataFrame:
        pts = self.cum.select(
            F.try_divide(F.col("cum_fp"), F.lit(float(self.n))).alias("fpr"),
            F.try_divide(F.col("cum_tp"), F.lit(float(self.p))).alias("tpr"))
        ends = self.spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "fpr double, tpr double")
        return pts.unionByName(ends)

    def auc(self) -> DataFrame:
        term = (F.col("fp").cast("decimal(38,0)")
                * (F.lit(2) * F.col("cum_tp") - F.col("tp")).cast("decimal(38,0)"))
        num = self.cum.agg(F.sum(term).alias("num"))
        den = float(2 * self.p * self.n)
        return num.select(F.try_divide(F.col("num").cast("double"), F.lit(den)).alias("auc"))

    def _f1_col(self):
        precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
        recall = F.col("cum_tp") / F.lit(float(self.p)) if self.p else F.lit(0.0)
        return F.when(precision + recall == 0, F.lit(0.0)).otherwise(
            F.lit(2.0) * precision * recall / (precision + recall))

    def _auc_num(self):
        return F.sum(F.col("fp").cast("decimal(38,0)")
                     * (F.lit(2) * F.col("cum_tp") - F.col("tp")).cast("decimal(38,0)"))

    def summary(self) -> dict[str, float]:
        """AUC and the F1-best (threshold, f1) from one aggregate over the curve."""
        row = self.cum.agg(
            self._auc_num().alias("num"),
            F.max(F.struct(self._f1_col().alias("f1"), F.col("score").alias("t"))).alias("b")
        ).first()
        den = float(2 * self.p * self.n)
        auc = float(row["num"]) / den if den and row["num"] is not None else None
        best = row["b"]
        return {"auc": auc, "best_threshold": best["t"] if best else None,
                "best_f1": best["f1"] if best else None}

    def f1(self) -> DataFrame:
        precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
        recall = F.col("cum_tp") / F.lit(float(self.p)) if self.p else F.lit(0.0)
        f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(
            F.lit(2.0) * precision * recall / (precision + recall))
        return self.cum.select(F.col("score").alias("threshold"), f1.alias("f1"))


def cumulative(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, tp, fp, cum_tp, cum_fp): counts at or above each score."""
    return ThresholdCurve(scored, score, label).cum


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(fpr, tpr) points from (0, 0) through each threshold to (1, 1) (EVAL-1)."""
    return ThresholdCurve(scored, score, label).roc()


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve by the trapezoid rule (EVAL-2).

    Each threshold adds fp * (cum_tp_before + cum_tp) / 2 / (P * N); the
    numerator is summed exactly as a 38-digit decimal and divided once.
    """
    return ThresholdCurve(scored, score, label).auc()


def hard_auc(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """AUC of hard 0/1 predictions (EVAL-2 as the training jobs call it).

    With two thresholds the trapezoid numerator of :func:`auc` reduces to
    ``P*N + TP*N - FP*P`` (over ``2*P*N``), so one aggregate gives the same
    value without building the curve.
    """
    pos, hit = _positive(label), F.col(prediction) > F.lit(0.5)
    c = pred.agg(F.count_if(pos).alias("p"), F.count_if(~pos).alias("n"),
                 F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp"))
    big = lambda name: F.col(name).cast("decimal(38,0)")
    num = big("p") * big("n") + big("tp") * big("n") - big("fp") * big("p")
    den = (F.lit(2) * big("p") * big("n")).cast("double")
    return c.select(F.try_divide(num.cast("double"), den).alias("auc"))


def hard_summary(pred: DataFrame, prediction: str = "prediction",
                 label: str = "label") -> dict[str, float]:
    """Accuracy and hard AUC of 0/1 predictions from one aggregate."""
    pos, hit = _positive(label), F.col(prediction) > F.lit(0.5)
    r = pred.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col(prediction) == F.col(label)).alias("same"),
                 F.count_if(pos).alias("p"), F.count_if(~pos).alias("n"),
                 F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp")).first()
    p, n = r["p"], r["n"]
    num = p * n + r["tp"] * n - r["fp"] * p          # exact Python integers
    return {"accuracy": r["same"] / r["rows"] if r["rows"] else None,
            "auc_hard": float(num) / float(2 * p * n) if p and n else None}


def f1_by_threshold(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, f1) for every distinct score (EVAL-4)."""
    return ThresholdCurve(scored, score, label).f1()


def best_threshold(f1: DataFrame) -> DataFrame:
    """Arg-max of F1; ties go to the higher threshold (RNK-4)."""
    best = f1.agg(F.max(F.struct("f1", "threshold")).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"))


def refined_threshold(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(best_threshold, best_f1, threshold): the F1-best threshold is used
    only inside the default +/- tolerance, else the default (ML-4)."""
    return choose_threshold(best_threshold(f1_by_threshold(scored, score, label)))


def choose_threshold(best: DataFrame) -> DataFrame:
    """(best_threshold, best_f1, threshold) from a (threshold, f1) best row."""
    low = C.DEFAULT_THRESHOLD - C.THRESHOLD_TOLERANCE
    high = C.DEFAULT_THRESHOLD + C.THRESHOLD_TOLERANCE
    t = F.col("threshold")
    chosen = F.when((t >= low) & (t <= high), t).otherwise(F.lit(C.DEFAULT_THRESHOLD))
    return best.select(t.alias("best_threshold"), F.col("f1").alias("best_f1"),
                       chosen.alias("threshold"))


def accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose prediction equals the label (EVAL-3)."""
    return pred.agg(F.try_divide(F.count_if(F.col(prediction) == F.col(label)),
                                 F.count(F.lit(1))).alias("accuracy"))


def confusion_counts(pred: DataFrame, prediction: str = "prediction",
                     label: str = "label") -> DataFrame:
    """(label, prediction, n) (EVAL-6)."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def per_class_metrics(pred: DataFrame, prediction: str = "prediction",
                      label: str = "label") -> DataFrame:
    """(label, precision, recall, f1) for every label value (EVAL-5).

    Works on the K x K confusion counts only, after one partial aggregate.
    """
    cm = confusion_counts(pred, prediction, label)
    by_label = cm.groupBy("label").agg(
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("actual"))
    by_pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    j = by_label.join(F.broadcast(by_pred), "label", "left").fillna(0, ["predicted"])
    precision = F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(
        F.col("tp") / F.col("predicted"))
    recall = F.col("tp") / F.col("actual")
    out = j.select("label", precision.alias("precision"), recall.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return out.select("label", "precision", "recall", f1.alias("f1"))
