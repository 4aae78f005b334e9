"""Logistic-regression training, refinement and scoring (ML-1..5, SET-1).

Training uses ``pyspark.ml``: gradients are aggregated across executors
(treeAggregate), so the labelled set never has to fit one machine.
Scoring is a per-row projection over all unlabelled devices.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from . import dataset as dsm
from . import metrics as met


def estimator(classes: int, max_iter: int = C.LR_MAX_ITER, tol: float = C.LR_TOL,
              reg_param: float = C.LR_REG_PARAM, fit_intercept: bool = C.LR_FIT_INTERCEPT,
              features: str = "features", label: str = "label") -> LogisticRegression:
    """L-BFGS logistic regression for ``classes`` classes (ML-1)."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, tol=tol, regParam=reg_param,
        elasticNetParam=0.0, fitIntercept=fit_intercept, standardization=True,
        family="binomial" if classes == 2 else "multinomial")


def with_output_cols(model: LogisticRegressionModel, suffix: str) -> LogisticRegressionModel:
    """Distinct output columns so several models can score one DataFrame."""
    return (model.setPredictionCol(f"prediction{suffix}")
            .setProbabilityCol(f"probability{suffix}")
            .setRawPredictionCol(f"raw{suffix}"))


def score(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` and ``score`` (probability of class 1) (ML-2, ML-3)."""
    out = model.transform(df)
    prob = vector_to_array(F.col(model.getProbabilityCol()))
    return (out.withColumn("score", F.get(prob, 1))
            .drop(model.getRawPredictionCol(), model.getProbabilityCol()))


def predict(model: LogisticRegressionModel, unlabelled: DataFrame) -> DataFrame:
    """(device_id, label) predicted for devices without a known label (ML-2)."""
    return model.transform(unlabelled).select(
        "device_id", F.col(model.getPredictionCol()).alias("label"))


def union_known_predicted(known: DataFrame, predicted: DataFrame) -> DataFrame:
    """(device_id, label, is_predicted): known labels plus predictions (SET-1)."""
    return (known.select("device_id", "label", F.lit(False).alias("is_predicted"))
            .unionByName(predicted.select("device_id", "label",
                                          F.lit(True).alias("is_predicted"))))


def evaluate(valid_scored: DataFrame, classes: int,
             curve: met.ThresholdCurve | None = None) -> dict[str, float]:
    """Validation scalars: hard AUC, score AUC and accuracy (binary);
    accuracy and per-class precision / recall / F1 (multi-class).

    ``curve`` (of the probability scores) is reused when given; its summary
    also carries the F1-best threshold.
    """
    if classes == 2:
        report = met.hard_summary(valid_scored)
        curve = curve or met.ThresholdCurve(valid_scored)
        report.update(curve.summary())
        return report
    report = {"accuracy": met.accuracy(valid_scored).first()["accuracy"]}
    for row in met.per_class_metrics(valid_scored).collect():
        k = int(row["label"])
        report[f"precision_{k}"] = row["precision"]
        report[f"recall_{k}"] = row["recall"]
        report[f"f1_{k}"] = row["f1"]
    return report


def chosen_threshold(best: float | None) -> float:
    """The F1-best threshold if within the default +/- tolerance, else the default."""
    low = C.DEFAULT_THRESHOLD - C.THRESHOLD_TOLERANCE
    high = C.DEFAULT_THRESHOLD + C.THRESHOLD_TOLERANCE
    return best if best is not None and low <= best <= high else C.DEFAULT_THRESHOLD


def refine_threshold(model: LogisticRegressionModel, valid: DataFrame,
                     curve: met.ThresholdCurve | None = None) -> tuple[float, float]:
    """Set the model threshold to the F1-best validation threshold when it
    lies within the default +/- tolerance, else to the default (ML-4).

    Returns (best threshold, threshold used).
    """
    curve = curve or met.ThresholdCurve(score(model, valid))
    best = curve.summary()["best_threshold"]
    used = chosen_threshold(best)
    model.setThreshold(float(used))
    return best, float(used)


def sized(kept: DataFrame, rows_per_partition: int = C.TRAIN_ROWS_PER_PARTITION) -> tuple[DataFrame, int]:
    """A persisted set narrowed to about one partition per
    ``rows_per_partition`` rows, and its row count.

    Every L-BFGS iteration is one job over all partitions of the training
    set; small labelled sets inherit the partitioning of the much larger
    feature table, and each extra near-empty task costs latency on every
    iteration. The one count fills the cache; ``coalesce`` merges the cached
    partitions without a shuffle.
    """
    rows, have = kept.count(), kept.rdd.getNumPartitions()
    want = max(1, -(-rows // rows_per_partition))
    return (kept.coalesce(want) if want < have else kept), rows


@dataclass
class TrainResult:
    model: LogisticRegressionModel
    classes: int
    report: dict[str, float] = field(default_factory=dict)
    threshold: float | None = None
    best_threshold: float | None = None
    model_path: str | None = None


def build_model(labelled: DataFrame, classes: int, refine: bool = False,
                train_percent: int = C.TRAIN_PERCENT, model_dir: str | None = None,
                name: str = "model", job_date: int = C.SAMPLE_JOB_DATE,
                holdout_percent: int = 0, split_seed: int | None = None,
                **params) -> TrainResult:
    """Split, train, evaluate, optionally refine, save (ML-5).

    The split hashes the device id (reproducible); ``split_seed`` switches
    to a seeded ``randomSplit`` instead. By default the threshold is tuned
    and reported on the same validation rows, as originally;
    ``holdout_percent`` > 0 tunes it on that many percent of all rows taken
    from the validation part and reports on the rest.

    The splits are persisted because L-BFGS passes over the training set
    once per iteration and the validation set is scored several times.
    """
    if split_seed is None:
        train, valid = dsm.split_train_valid(labelled, "device_id", train_percent)
    else:
        train, valid = labelled.randomSplit(
            [train_percent / 100, 1 - train_percent / 100], seed=split_seed)
    tune = valid
    if holdout_percent:
        cut = dsm.hash_bucket("device_id") < train_percent + holdout_percent
        tune, valid = valid.where(cut), valid.where(~cut)
    kept = [df.persist(StorageLevel.MEMORY_AND_DISK)
            for df in ((train, valid, tune) if holdout_percent else (train, valid))]
    try:
        train, rows = sized(kept[0])
        valid, _ = sized(kept[1])
        tune = sized(kept[2])[0] if holdout_percent else valid
        if not rows:
            raise ValueError(f"no labelled training rows for {name} on {job_date}")
        model = estimator(classes, **params).fit(train)
        result = TrainResult(model, classes)
        scored = score(model, valid).select("label", "prediction", "score").persist()
        curve = met.ThresholdCurve(scored) if classes == 2 else None
        result.report = evaluate(scored, classes, curve)
        scored.unpersist()
        if classes == 2 and refine:
            # probabilities do not depend on the threshold: the curve is reused
            if holdout_percent:
                result.best_threshold, result.threshold = refine_threshold(model, tune)
            else:
                result.best_threshold = result.report["best_threshold"]
                result.threshold = chosen_threshold(result.best_threshold)
                model.setThreshold(float(result.threshold))
            refined = met.hard_summary(score(model, valid))
            result.report.update({f"refined_{k}": v for k, v in refined.items()})
        if model_dir:
            from ..sources.sinks import save_model
            result.model_path = save_model(model, model_dir, name, job_date)
        return result
    finally:
        for df in kept:
            df.unpersist()
