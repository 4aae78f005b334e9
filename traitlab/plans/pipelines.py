"""Jobs: feature build (PIPE-1) and attribute inference (PIPE-2..12).

An attribute is data (:class:`AttributeSpec`); one generic job trains and
scores any of them. ``infer_all`` shares the work of all attributes: one
label shuffle, one features-to-labels join, and one scoring pass that
applies every model to each device row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from ..operators import catalog as cat
from ..operators import dataset as dsm
from ..operators import exact
from ..operators import features as feat
from ..operators import labels as lbl
from ..operators import model as mdl
from ..session import checkpoint_dir, delete_on_exit, scratch_path
from ..sources import publish, sinks
from .context import JobContext


@dataclass(frozen=True)
class AttributeSpec:
    name: str
    classes: int
    refine: bool = False


# Attributes, class counts, and which one tunes its threshold.
ATTRIBUTES = {
    "gender": AttributeSpec("gender", 2, refine=True),
    "age": AttributeSpec("age", 5),
    "marital": AttributeSpec("marital", 2),
    "parent": AttributeSpec("parent", 2),
    "child": AttributeSpec("child", 3),
    "car": AttributeSpec("car", 2),
    "consumption": AttributeSpec("consumption", 2),
    "estate": AttributeSpec("estate", 2),
    "income": AttributeSpec("income", 2),
    "education": AttributeSpec("education", 3),
    "career": AttributeSpec("career", 2),
}


def known_labels(ctx: JobContext, attribute: str) -> DataFrame:
    """(device_id, label) known for one attribute."""
    if attribute == "gender":
        return lbl.gender_label(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date)
    if attribute == "age":
        return lbl.age_label(ctx.view("users_info"), ctx.view("age_device_rel"), ctx.job_date)
    if attribute == "child":
        return lbl.child_label(ctx.view("child_stage"))
    return lbl.question_label(ctx.view("questionnaire"), attribute)


def all_known_labels(ctx: JobContext, attributes: list[str], raw: bool = False) -> DataFrame:
    """(attribute, device_id, label) of many attributes: the questionnaire
    ones from a single scan, the account ones each from the join with its own
    device relation. ``raw=True`` skips the per-labeler dedup (the caller
    aggregates with ``min`` anyway)."""
    qs = tuple(a for a in attributes if a in lbl.QUESTION_RULES)
    parts = []
    if qs or "child" in attributes:
        parts.append(lbl.questionnaire_long(
            ctx.view("questionnaire"),
            ctx.view("child_stage") if "child" in attributes else None, qs, raw=raw))
    account = {"gender": (lbl.gender_rows, "device_rel"), "age": (lbl.age_rows, "age_device_rel")}
    for a, (rows, devices) in account.items():
        if a in attributes:
            found = rows(ctx.view("users_info"), ctx.view(devices), ctx.job_date)
            found = found.select(F.lit(a).alias("attribute"), "device_id", "label")
            parts.append(found if raw else lbl.dedup(found, ("attribute", "device_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label_matrix(ctx: JobContext, attributes: list[str],
                 label_source: Callable[..., DataFrame] = all_known_labels) -> DataFrame:
    """One row per labelled device with a ``label_<attribute>`` column each.

    One shuffle: a conditional min per attribute is both the pivot and the
    per-(attribute, device) dedup (a pivot would aggregate twice).
    """
    rows = label_source(ctx, attributes, raw=True)
    return rows.groupBy("device_id").agg(
        *[F.min(F.when(F.col("attribute") == a, F.col("label"))).alias(f"label_{a}")
          for a in attributes])


# --- PIPE-1 ------------------------------------------------------------------------

@dataclass
class FeatureBuild:
    catalog: DataFrame        # (appid, app_name, installnum, idx)
    features: DataFrame       # (device_id, feature)
    items: DataFrame          # (device_id, items) incl. devices without hits


def build_features(ctx: JobContext, installs_view: str = "user_installs",
                   catalog_view: str = "app_catalog", prefix: str = C.ITEM_PREFIX,
                   top_k: int | None = None, out_dir: str | None = None,
                   files: int | None = None) -> FeatureBuild:
    """Rank the catalog once and encode an install table (FEAT-1..4).

    With ``out_dir`` the catalog and the features are written as dated
    partitions (``catalog/`` and ``features/``), overwriting only this date.
    """
    dedup = cat.keep_max_installs(cat.catalog_rows(ctx.view(catalog_view), ctx.job_date))
    ranked = cat.rank_catalog(dedup)          # checkpointed inside
    lookup = feat.lookup_for(ranked, prefix, top_k)
    items = feat.items_of(ctx.view(installs_view), ctx.job_date, lookup)
    features = feat.encode(items)
    if out_dir:
        date = F.lit(int(ctx.job_date)).alias("stat_date")
        sinks.overwrite_partitions(ranked.select("*", date), f"{out_dir}/catalog", files=files)
        sinks.overwrite_partitions(features.select("*", date), f"{out_dir}/features", files=files)
    return FeatureBuild(ranked, features, items)


def feature_job(ctx: JobContext, out_dir: str, top_k: int | None = None,
                files: int | None = None, run_id: str | None = None) -> dict[str, int]:
    """PIPE-1: rank the catalog once, encode the main (prefixed ids) and the
    push (plain ids) install tables with it, and write the three dated
    tables ``catalog/``, ``features/`` and ``features_push/`` (published tables
    with ``run_id``).

    Returns row counts and the install coverage of the main table, whose items
    are kept for both. (``DataFrame.observe`` would give the counts in the writing
    pass, but in Spark 4.1 a session that has observed anything can no longer
    serialize ``CountVectorizerModel``, which the L-BFGS option needs.)
    """
    main = build_features(ctx, "user_installs", "app_catalog", C.ITEM_PREFIX, top_k)
    date = F.lit(int(ctx.job_date)).alias("stat_date")

    def write(df: DataFrame, name: str) -> None:
        df = df.select("*", date)
        if run_id:
            publish.publish(df, f"{out_dir}/{name}", run_id, files=files)
        else:
            sinks.overwrite_partitions(df, f"{out_dir}/{name}", files=files)

    write(main.catalog, "catalog")
    items = main.items.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write(feat.encode(items), "features")
        stats = feat.item_stats(items).first().asDict()
    finally:
        items.unpersist()
    lookup = feat.lookup_for(main.catalog, "", top_k)
    push = feat.encode(feat.items_of(ctx.view("user_installs_push"), ctx.job_date, lookup))
    write(push, "features_push")
    stats["n_catalog"] = main.catalog.count()
    return stats


def read_features(spark, path: str, job_date: int) -> DataFrame:
    """The dated features table written by :func:`feature_job` (SRC-1)."""
    table = publish.read_published(spark, path) if publish.is_published(spark, path) else spark.read.parquet(path)
    return feat.feature_rows(table, job_date)


def vectors_from(features: DataFrame, dim: int = C.FEATURE_DIM) -> DataFrame:
    """(device_id, features vector) from feature strings (FEAT-5, FEAT-6)."""
    return feat.vectors(features, dim)


def parsed_table(features: DataFrame, dim: int = C.FEATURE_DIM) -> DataFrame:
    """(device_id, indices, values) written once, so that the regexes run once
    per string; devices without an index are left out on reading (FLT-8)."""
    rows = materialize_table(feat.parse_rows(features, dim), "parsed")
    return rows.where(F.size("indices") > 0)


def feature_table(ctx: JobContext, table: str, buckets: int = C.FEATURE_BUCKETS, path: str | None = None,
                  features: DataFrame | None = None) -> None:
    """Write the date's feature strings with their parsed arrays as a table
    bucketed by device (PIPE-1, FEAT-5).

    The one shuffle of the features is here, once a day; every attribute job
    that reads the table joins its labels to it in place (JOIN-2) and parses
    nothing.
    """
    features = features if features is not None else ctx.features
    parsed = feat.parse_rows(features.select("device_id", "feature"), carry=("feature",))
    sinks.bucketed_table(parsed.withColumn("stat_date", F.lit(int(ctx.job_date))), table, "device_id", buckets,
                         path=path)


def read_feature_table(spark, table: str, job_date: int) -> DataFrame:
    """(device_id, indices, values) of a date of :func:`feature_table` (FLT-8)."""
    rows = feat.dated_scan(spark.table(table), job_date, ["device_id", "indices", "values"])
    return rows.where(F.size("indices") > 0)


# --- PIPE-2..12 ------------------------------------------------------------------------

@dataclass
class Inference:
    output: DataFrame                     # (device_id, attribute, label, is_predicted, stat_date)
    results: dict[str, mdl.TrainResult]
    skipped: tuple[str, ...] = ()         # attributes without a labelled device


def _long_output(df: DataFrame, attribute: str, job_date: int) -> DataFrame:
    return df.select("device_id", F.lit(attribute).alias("attribute"), "label", "is_predicted",
                     F.lit(int(job_date)).alias("stat_date"))


def _write(out: DataFrame, out_dir: str, append: bool, run_id: str | None = None) -> None:
    columns = ["stat_date", "attribute"]
    if run_id:
        publish.publish(out, out_dir, run_id, columns, append)
        return
    write = sinks.append_partitions if append else sinks.overwrite_partitions
    write(out, out_dir, columns)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Used where the original jobs wrote a table between steps (the feature
    table): later passes read the files instead of recomputing the plan,
    and a lost executor costs a re-read, not a recomputation.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back.

    For the large feature intermediates: compressed and columnar (later
    passes read only the columns they use), and, like a checkpoint, a lost
    executor costs a re-read. The folder belongs to the application's
    checkpoint directory.
    """
    spark = df.sparkSession
    path = delete_on_exit(spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}"))
    df.write.parquet(path)
    return spark.read.parquet(path)


# Options that only the L-BFGS estimator has.
_LBFGS_ONLY = ("reg_param", "fit_intercept")


def solver_for(solver: str | None, params: dict) -> str:
    """``exact`` (order-independent, all attributes per pass) unless asked for
    ``lbfgs`` or for an option that only L-BFGS has."""
    asked = [k for k in _LBFGS_ONLY if params.get(k)]
    if solver not in (None, "exact", "lbfgs"):
        raise ValueError(f"unknown solver {solver}")
    if solver == "exact" and asked:
        raise ValueError(f"the exact solver has no {', '.join(asked)}")
    return solver or ("lbfgs" if asked else "exact")


def infer_labels(parsed: DataFrame, labels: DataFrame, attribute: str, classes: int,
                 refine: bool, job_date: int, model_dir: str | None = None,
                 dim: int = C.FEATURE_DIM, solver: str | None = None, **params) -> Inference:
    """Train on devices with a known label, predict the rest, union both.

    ``parsed`` holds index arrays. Labels are joined to them first; the (small)
    labelled set is written once for training and validation, and one row-local
    pass scores the unlabelled devices.
    """
    # The labels feed a size proof and then the join: materialize them once so
    # their upstream (e.g. the account-device join) runs once.
    ds = dsm.attach_labels(parsed, materialize(labels))
    if solver_for(solver, params) == "exact":
        return exact_inference(ds, [exact.Target(attribute, classes, "label", refine)], job_date, model_dir,
                               dim, **params)
    # checkpointed, not cached: the returned plan reads it long after this call
    labelled = materialize(feat.vectorize(ds.where(dsm.is_labelled()), dim)
                           .select("device_id", "label", "features"))
    unlabelled = feat.vectorize(ds.where(~dsm.is_labelled()), dim)
    result = mdl.build_model(labelled, classes, refine, model_dir=model_dir, name=attribute,
                             job_date=job_date, **params)
    predicted = mdl.predict(result.model, unlabelled)
    out = mdl.union_known_predicted(labelled.select("device_id", "label"), predicted)
    return Inference(_long_output(out, attribute, job_date), {attribute: result})


def _labelled_table(ds: DataFrame, cols: list[str]) -> DataFrame:
    """The rows of ``ds`` with any known label, written once."""
    known = F.lit(False)
    for c in cols:
        known = known | dsm.is_labelled(c)
    return materialize_table(ds.where(known).select("device_id", "indices", "values", *cols), "labelled")


def exact_models(labelled: DataFrame, targets: list[exact.Target], job_date: int, dim: int = C.FEATURE_DIM,
                 train_percent: int = C.TRAIN_PERCENT, holdout_percent: int = 0, split_seed: int | None = None,
                 reg_param: float = 0.0, fit_intercept: bool = False, **params):
    """(weights, validation rows scored by them, reports) of several targets,
    from (device_id, indices, values, label columns) rows (ML-1, ML-3..5).

    The split hashes the device id, or the seed and the id; options are those
    of :func:`model.build_model`.
    """
    if reg_param or fit_intercept:
        raise ValueError("the exact solver has no penalty and no intercept")
    key = F.col("device_id") if split_seed is None else F.concat_ws(":", F.lit(str(split_seed)), F.col("device_id"))
    rows = labelled.withColumn("bucket", dsm.hash_bucket(key))
    train, rest = rows.where(F.col("bucket") < train_percent), rows.where(F.col("bucket") >= train_percent)
    sizes = train.agg(*[F.count_if(dsm.is_labelled(t.label)).alias(t.name) for t in targets]).first()
    for t in targets:
        if not sizes[t.name]:
            raise ValueError(f"no labelled training rows for {t.name} on {job_date}")
    weights = exact.fit(train, targets, dim, **params)
    scored = exact.score(rest, weights)
    scores = exact.long_scores(scored, targets, "bucket").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if holdout_percent:
            tuning = F.col("bucket") < train_percent + holdout_percent
            reports = exact.validate(scores.where(~tuning), weights, scores.where(tuning))
        else:
            reports = exact.validate(scores, weights)
    finally:
        scores.unpersist()
    return weights, scored, reports


def exact_inference(ds: DataFrame, targets: list[exact.Target], job_date: int, model_dir: str | None = None,
                    dim: int = C.FEATURE_DIM, labelled: DataFrame | None = None, **params) -> Inference:
    """Train all targets together on the labelled rows of ``ds`` (device_id,
    indices, values, label columns; ``labelled`` where they are at hand), then
    score every row once."""
    cols = [t.label for t in targets]
    labelled = labelled if labelled is not None else _labelled_table(ds, cols)
    weights, _, reports = exact_models(labelled, targets, job_date, dim, **params)
    results = {}
    for t in targets:
        report = reports[t.name]
        results[t.name] = res = mdl.TrainResult(weights, t.classes, report, weights.thresholds.get(t.name),
                                                report.pop("tuned_threshold", None))
        if model_dir:
            res.model_path = sinks.model_path(model_dir, t.name, job_date)
            weights.save(ds.sparkSession, res.model_path, t.name)
    scored = exact.score(ds.select("device_id", "indices", "values", *cols), weights)
    pairs = [F.struct(F.lit(t.name).alias("attribute"),
                      F.when(dsm.is_labelled(t.label), F.col(t.label)).otherwise(F.col(f"prediction_{t.name}")).alias("label"),
                      (~dsm.is_labelled(t.label)).alias("is_predicted")) for t in targets]
    out = scored.select("device_id", F.inline(F.array(*pairs))).withColumn("stat_date", F.lit(int(job_date)))
    return Inference(out, results)


def infer(ctx: JobContext, attribute: str, features: DataFrame | None = None,
          out_dir: str | None = None, model_dir: str | None = None, append: bool = False,
          run_id: str | None = None, parsed: DataFrame | None = None, **params) -> Inference:
    """One attribute job (PIPE-2..12); ``append`` adds rows to the output
    instead of replacing the date's partition; with ``run_id`` the output is a
    published table, replaced in one step and appended to once per run. ``parsed``
    gives index arrays at hand (:func:`read_feature_table`) instead of features."""
    spec = ATTRIBUTES[attribute]
    if parsed is None:
        parsed = parsed_table(features if features is not None else ctx.features)
    res = infer_labels(parsed, known_labels(ctx, attribute), attribute, spec.classes,
                       spec.refine, ctx.job_date, model_dir, **params)
    if out_dir:
        _write(res.output, out_dir, append, run_id)
    return res


def infer_all(ctx: JobContext, attributes: list[str] | None = None,
              features: DataFrame | None = None, out_dir: str | None = None,
              model_dir: str | None = None,
              label_source: Callable[..., DataFrame] = all_known_labels,
              parallelism: int | None = None, append: bool = False, run_id: str | None = None,
              solver: str | None = None, parsed: DataFrame | None = None, **params) -> Inference:
    """All attribute jobs over shared work.

    Labels of every attribute become one row per device (one shuffle,
    :func:`label_matrix`) and are joined to the index arrays once. The exact
    solver trains all attributes in the same passes over the labelled rows, one
    job per iteration; L-BFGS fits one model per attribute from concurrent
    threads. One scoring pass applies every model. Attributes without any
    labelled device are skipped and named in the result.
    """
    attributes = attributes or list(ATTRIBUTES)
    if parsed is None:
        parsed = parsed_table(features if features is not None else ctx.features)
    cols = [f"label_{a}" for a in attributes]
    wide = materialize(label_matrix(ctx, attributes, label_source))
    ds = dsm.attach_labels(parsed, wide, cols)
    labelled = _labelled_table(ds, cols)
    present = labelled.agg(*[F.count_if(dsm.is_labelled(c)).alias(c) for c in cols]).first()
    skipped = tuple(a for a, c in zip(attributes, cols) if not present[c])
    attributes = [a for a in attributes if a not in skipped]
    if solver_for(solver, params) == "exact":
        targets = [exact.Target(a, ATTRIBUTES[a].classes, f"label_{a}", ATTRIBUTES[a].refine) for a in attributes]
        res = exact_inference(ds, targets, ctx.job_date, model_dir, labelled=labelled, **params)
    else:
        res = _lbfgs_inference(ds, labelled, attributes, ctx.job_date, model_dir, parallelism, **params)
    res.skipped = skipped
    if out_dir:
        _write(res.output, out_dir, append, run_id)
    return res


def _lbfgs_inference(ds: DataFrame, labelled: DataFrame, attributes: list[str], job_date: int,
                     model_dir: str | None, parallelism: int | None, **params) -> Inference:
    cols = [f"label_{a}" for a in attributes]
    labelled = materialize(feat.vectorize(labelled).select("device_id", "features", *cols))

    def fit(a: str, c: str) -> mdl.TrainResult:
        spec = ATTRIBUTES[a]
        train_set = labelled.where(dsm.is_labelled(c)).select(
            "device_id", "features", F.col(c).alias("label"))
        return mdl.build_model(train_set, spec.classes, spec.refine, model_dir=model_dir,
                               name=a, job_date=job_date, **params)

    # The models are independent: fitting them from several driver threads
    # runs their small per-iteration jobs side by side on the executors.
    # One thread per attribute by default: eleven concurrent fits at most.
    with ThreadPoolExecutor(max_workers=max(1, parallelism or len(attributes))) as pool:
        futures = {a: pool.submit(fit, a, c) for a, c in zip(attributes, cols)}
        results = {a: f.result() for a, f in futures.items()}

    scored = feat.vectorize(ds)
    for a in attributes:
        m = mdl.with_output_cols(results[a].model, f"_{a}")
        scored = m.transform(scored).drop(m.getRawPredictionCol(), m.getProbabilityCol())

    pairs = []
    for a, c in zip(attributes, cols):
        known = dsm.is_labelled(c)
        pairs.append(F.struct(
            F.lit(a).alias("attribute"),
            F.when(known, F.col(c)).otherwise(F.col(f"prediction_{a}")).alias("label"),
            (~known).alias("is_predicted")))
    out = (scored.select("device_id", F.explode(F.array(*pairs)).alias("r"))
           .select("device_id", "r.attribute", "r.label", "r.is_predicted",
                   F.lit(int(job_date)).alias("stat_date")))
    return Inference(out, results)


# --- documents: the learning check ------------------------------------------------------

def document_features(ctx: JobContext) -> DataFrame:
    """Feature strings of the documents (words play installed items)."""
    return build_features(ctx, "doc_items", "doc_catalog", prefix="").features


def infer_documents(ctx: JobContext, target: str = "quality", refine: bool = True,
                    **params) -> Inference:
    """Binary inference of a partially known document label."""
    labels = ctx.view("doc_labels" if target == "quality" else "doc_labels_toxic")
    return infer_labels(parsed_table(document_features(ctx)), labels, target, 2, refine, ctx.job_date, **params)
