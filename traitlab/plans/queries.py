"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input; column names equal those of :mod:`traitlab.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as C
from ..functions.dates import normalise_date_col
from ..operators import catalog as cat
from ..operators import dataset as dsm
from ..operators import exact
from ..operators import features as feat
from ..operators import labels as lbl
from ..operators import metrics as met
from ..operators import model as mdl
from ..session import delete_on_exit, scratch_path
from ..sources import publish, sinks
from ..sources import snapshot as snap
from . import pipelines as pipe
from .context import JobContext

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Callable[[JobContext], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(JobContext(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return wrap


# --- catalog ---------------------------------------------------------------

@query("catalog_max_installs")
def _catalog_max_installs(ctx: JobContext) -> DataFrame:
    """AGG-2: one row per item with its largest install count."""
    return ctx.catalog_dedup


@query("catalog_index")
def _catalog_index(ctx: JobContext) -> DataFrame:
    """RNK-1: global 0-based index by installs desc, id asc."""
    return ctx.catalog_ranked.select("appid", "app_name", "installnum", "idx")


@query("catalog_topk")
def _catalog_topk(ctx: JobContext) -> DataFrame:
    """RNK-2: the TOP_K most installed items with their index."""
    return cat.top_k(ctx.catalog_dedup, C.TOP_K).select("appid", "app_name", "installnum", "idx")


# --- feature encode ----------------------------------------------------------

@query("tokens_exploded")
def _tokens_exploded(ctx: JobContext) -> DataFrame:
    """STR-1: the item key of every install token."""
    return feat.install_tokens(feat.install_rows(ctx.view("user_installs"), ctx.job_date))


@query("join_install_catalog")
def _join_install_catalog(ctx: JobContext) -> DataFrame:
    """JOIN-3: install tokens matched to the catalog lookup."""
    lookup = feat.lookup_for(ctx.catalog_ranked, C.ITEM_PREFIX, None)
    tokens = feat.install_tokens(feat.install_rows(ctx.view("user_installs"), ctx.job_date))
    return feat.match_catalog(tokens, lookup).select("device_id", "key", "idx")


@query("features_encoded")
def _features_encoded(ctx: JobContext) -> DataFrame:
    """FEAT-2/3: feature strings of the main install table (prefix on)."""
    return ctx.features


@query("features_encoded_push")
def _features_encoded_push(ctx: JobContext) -> DataFrame:
    """FEAT-4: feature strings of the push install table (prefix off)."""
    return feat.encode(ctx.items("user_installs_push", ""))


@query("install_coverage")
def _install_coverage(ctx: JobContext) -> DataFrame:
    """FLT-10: devices in total, without any catalog hit, and kept."""
    return feat.coverage(ctx.main_items)


@query("install_length_stats")
def _install_length_stats(ctx: JobContext) -> DataFrame:
    """AGG-6: min / max distinct items of the kept devices."""
    return feat.length_stats(ctx.main_items)


@query("features_parsed")
def _features_parsed(ctx: JobContext) -> DataFrame:
    """FEAT-5: (device, index, value) of every valid feature token."""
    p = ctx.parsed
    return p.select("device_id", F.inline(F.arrays_zip(
        F.col("indices").alias("idx"), F.col("values").alias("value"))))


# --- filters and labels ---------------------------------------------------------


@query("scan_dated")
def _scan_dated(ctx: JobContext) -> DataFrame:
    """SRC-1: dated snapshot scan with a projection."""
    return snap.dated_scan(ctx.view("users_info"), ctx.job_date, ["user_id", "sex", "birthdate"])


@query("filter_not_null")
def _filter_not_null(ctx: JobContext) -> DataFrame:
    """FLT-1: device relation rows with both ids present."""
    rows = snap.dated_scan(ctx.view("device_rel"), ctx.job_date, ["uid", "device_id"])
    return snap.not_null(rows, "uid", "device_id")


@query("filter_answered")
def _filter_answered(ctx: JobContext) -> DataFrame:
    """FLT-2: questionnaire rows with a non-empty car answer."""
    return lbl.answered_rows(ctx.view("questionnaire"), "q8")


@query("filter_in_set")
def _filter_in_set(ctx: JobContext) -> DataFrame:
    """FLT-3: marital answers within the selected set."""
    q = ctx.view("questionnaire").select("device_id", "q4")
    return q.where(F.col("q4").isin(*lbl.MARITAL_SELECTED))


@query("join_user_device")
def _join_user_device(ctx: JobContext) -> DataFrame:
    """JOIN-1: users with sex 1 or 2 joined to their devices."""
    return lbl.user_devices(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date,
                            ["sex"], F.col("sex").isin(1, 2)).select("device_id", "user_id", "sex")


@query("label_gender")
def _label_gender(ctx: JobContext) -> DataFrame:
    """LBL-1."""
    return lbl.gender_label(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date)


@query("label_age")
def _label_age(ctx: JobContext) -> DataFrame:
    """LBL-2."""
    return lbl.age_label(ctx.view("users_info"), ctx.view("age_device_rel"), ctx.job_date)


@query("label_marital_age")
def _label_marital_age(ctx: JobContext) -> DataFrame:
    """LBL-3."""
    return lbl.marital_from_age(ctx.view("age_collect"), ctx.job_date)


def _register_question(attribute: str, ident: str) -> None:
    def fn(ctx: JobContext) -> DataFrame:
        return lbl.question_label(ctx.view("questionnaire"), attribute)
    fn.__doc__ = f"{ident}: questionnaire labels of {attribute}."
    query(f"label_{attribute}")(fn)


for _attr, _ident in (("marital", "LBL-4"), ("parent", "LBL-5"), ("car", "LBL-7"),
                      ("consumption", "LBL-8"), ("estate", "LBL-9"), ("income", "LBL-10"),
                      ("education", "LBL-11"), ("career", "LBL-12")):
    _register_question(_attr, _ident)


@query("label_child")
def _label_child(ctx: JobContext) -> DataFrame:
    """LBL-6."""
    return lbl.child_label(ctx.view("child_stage"))


@query("labels_long")
def _labels_long(ctx: JobContext) -> DataFrame:
    """LBL-0: all questionnaire and child-stage labels from one scan."""
    return lbl.questionnaire_long(ctx.view("questionnaire"), ctx.view("child_stage"))


@query("dedup_labels")
def _dedup_labels(ctx: JobContext) -> DataFrame:
    """AGG-1: labelled rows before and devices after the per-device dedup."""
    rows = lbl.answer_labels(ctx.view("questionnaire"), lbl.answer_rule("parent"))
    shared = lbl.gender_rows(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date)
    both = (rows.withColumn("attribute", F.lit("parent"))
            .unionByName(shared.withColumn("attribute", F.lit("gender"))))
    per_dev = both.groupBy("attribute", "device_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("label"))
    return per_dev.groupBy("attribute").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_devices"),
        F.sum("label").alias("label_sum"))


@query("label_distribution")
def _label_distribution(ctx: JobContext) -> DataFrame:
    """AGG-3: class counts and ratios of the gender labels."""
    return lbl.distribution(
        lbl.gender_label(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date))


@query("label_distribution_str")
def _label_distribution_str(ctx: JobContext) -> DataFrame:
    """AGG-4: distribution of a text label (child stage answers as given)."""
    rows = snap.not_null(ctx.view("child_stage").select("device_id", "child_stage"),
                         "device_id", "child_stage")
    return lbl.distribution(rows, "child_stage")


# --- dataset assembly ---------------------------------------------------------------


def _gender(ctx: JobContext) -> DataFrame:
    return lbl.gender_label(ctx.view("users_info"), ctx.view("device_rel"), ctx.job_date)


def _gender_dataset(ctx: JobContext) -> DataFrame:
    return dsm.attach_labels(ctx.parsed, _gender(ctx))


@query("join_features_labels")
def _join_features_labels(ctx: JobContext) -> DataFrame:
    """JOIN-2: every feature row with its gender label or -1."""
    return dsm.attach_labels(ctx.features, _gender(ctx)).select("device_id", "label")


@query("join_features_bucketed")
def _join_features_bucketed(ctx: JobContext) -> DataFrame:
    """JOIN-2 from the bucketed feature table, labels beyond the broadcast bound:
    the features are not exchanged."""
    table = f"features_{uuid.uuid4().hex}"
    pipe.feature_table(ctx, table, buckets=8, path=_scratch_dir(ctx, table))
    parsed = pipe.read_feature_table(ctx.spark, table, ctx.job_date)
    return dsm.attach_labels(parsed, _gender(ctx), max_broadcast_rows=0).select("device_id", "label")


@query("split_labelled")
def _split_labelled(ctx: JobContext) -> DataFrame:
    """SPL-2: devices with a parsed vector, marked labelled / unlabelled."""
    ds = _gender_dataset(ctx)
    part = F.when(dsm.is_labelled(), F.lit("labelled")).otherwise(F.lit("unlabelled"))
    return ds.select("device_id", "label", part.alias("part"))


@query("split_train_valid")
def _split_train_valid(ctx: JobContext) -> DataFrame:
    """SPL-1: labelled devices marked train / valid by the hash split."""
    labelled, _ = dsm.split_labelled(_gender_dataset(ctx))
    part = F.when(dsm.in_train("device_id"), F.lit("train")).otherwise(F.lit("valid"))
    return labelled.select("device_id", "label", part.alias("part"))


@query("dataset_counts")
def _dataset_counts(ctx: JobContext) -> DataFrame:
    """AGG-5: total / labelled / unlabelled / train / valid sizes."""
    return dsm.counts(_gender_dataset(ctx))


# --- metrics on the scored table ------------------------------------------------------

def _scored(ctx: JobContext) -> DataFrame:
    return ctx.view("scored")


def _hard(ctx: JobContext) -> DataFrame:
    s = _scored(ctx)
    return s.withColumn("prediction", F.when(F.col("score") > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


@query("roc_curve")
def _roc_curve(ctx: JobContext) -> DataFrame:
    """EVAL-1."""
    return met.roc_curve(_scored(ctx))


@query("auc_scores")
def _auc_scores(ctx: JobContext) -> DataFrame:
    """EVAL-2 on scores."""
    return met.auc(_scored(ctx))


@query("auc_hard")
def _auc_hard(ctx: JobContext) -> DataFrame:
    """EVAL-2 on hard predictions, as the training jobs call it."""
    return met.hard_auc(_hard(ctx))


@query("accuracy")
def _accuracy(ctx: JobContext) -> DataFrame:
    """EVAL-3."""
    return met.accuracy(_hard(ctx))


@query("f1_by_threshold")
def _f1_by_threshold(ctx: JobContext) -> DataFrame:
    """EVAL-4."""
    return met.f1_by_threshold(_scored(ctx))


@query("best_threshold")
def _best_threshold(ctx: JobContext) -> DataFrame:
    """RNK-4."""
    return met.best_threshold(met.f1_by_threshold(_scored(ctx)))


@query("refined_threshold")
def _refined_threshold(ctx: JobContext) -> DataFrame:
    """ML-4 on the scored table."""
    return met.refined_threshold(_scored(ctx))


@query("per_class_metrics")
def _per_class_metrics(ctx: JobContext) -> DataFrame:
    """EVAL-5."""
    return met.per_class_metrics(_hard(ctx))


@query("confusion_counts")
def _confusion_counts(ctx: JobContext) -> DataFrame:
    """EVAL-6."""
    return met.confusion_counts(_hard(ctx))


# --- dates ------------------------------------------------------------------------------


@query("job_date_normalise")
def _job_date_normalise(ctx: JobContext) -> DataFrame:
    """DAT-1: run dates with out-of-range months and days, read leniently.

    The yyyyMMdd texts are derived from order keys (months up to 14, days
    up to 35) so every order row contributes one date to normalise.
    """
    o = ctx.tables["orders"].select("o_orderkey")
    k = F.col("o_orderkey")
    text = F.concat(F.lpad((F.lit(1992) + k % 7).cast("string"), 4, "0"),
                    F.lpad((F.lit(1) + k % 14).cast("string"), 2, "0"),
                    F.lpad((F.lit(1) + k % 35).cast("string"), 2, "0"))
    return o.select("o_orderkey", text.alias("job_time"),
                    normalise_date_col(text).alias("job_date"))


# --- models and jobs ----------------------------------------------------------------------


@query("label_matrix")
def _label_matrix(ctx: JobContext) -> DataFrame:
    """LBL-0..12 of every attribute as one row per labelled device (the
    all-attribute job's labels): one account join, one aggregate."""
    return pipe.label_matrix(ctx, list(pipe.ATTRIBUTES))


@query("union_known_predicted")
def _union_known_predicted(ctx: JobContext) -> DataFrame:
    """SET-1 with a deterministic stand-in scorer: unlabelled devices get
    (number of parsed tokens) mod 2 as their predicted class."""
    ds = dsm.attach_labels(pipe.parsed_table(ctx.features), pipe.materialize(_gender(ctx)))  # read by both parts
    labelled, unlabelled = dsm.split_labelled(ds)
    stand_in = unlabelled.select("device_id", (F.size("indices") % 2).cast("double").alias("label"))
    return mdl.union_known_predicted(labelled.select("device_id", "label"), stand_in)


@query("doc_features")
def _doc_features(ctx: JobContext) -> DataFrame:
    """PIPE-1 on documents: word catalog, ranked, encoded per document."""
    return pipe.document_features(ctx)


def _labelled(ctx: JobContext, parsed: DataFrame, labels: DataFrame) -> DataFrame:
    return dsm.split_labelled(dsm.attach_labels(parsed, labels))[0]


def _doc_labelled(ctx: JobContext) -> DataFrame:
    return _labelled(ctx, pipe.parsed_table(pipe.document_features(ctx)), ctx.view("doc_labels"))


def _age_labelled(ctx: JobContext) -> DataFrame:
    return _labelled(ctx, pipe.parsed_table(ctx.features), pipe.known_labels(ctx, "age"))


def _validated(labelled: DataFrame, target: exact.Target, job_date: int) -> DataFrame:
    weights, _, _ = pipe.exact_models(labelled, [target], job_date)
    _, valid = dsm.split_train_valid(labelled)
    return exact.score(valid.select("device_id", "indices", "values", "label"), weights).select(
        "device_id", "label", F.col(f"prediction_{target.name}").alias("prediction"))


@query("train_binary")
def _train_binary(ctx: JobContext) -> DataFrame:
    """ML-1/ML-5 binary (documents, quality): validation predictions."""
    return _validated(_doc_labelled(ctx), exact.Target("quality", 2, "label", refine=True), ctx.job_date)


@query("train_multiclass")
def _train_multiclass(ctx: JobContext) -> DataFrame:
    """ML-1/ML-5 multi-class (age bands, 5 classes): validation predictions."""
    return _validated(_age_labelled(ctx), exact.Target("age", 5, "label"), ctx.job_date)


def _validated_lbfgs(labelled: DataFrame, classes: int, refine: bool) -> DataFrame:
    labelled = feat.vectorize(labelled)
    res = mdl.build_model(labelled, classes, refine=refine)
    _, valid = dsm.split_train_valid(labelled)
    return mdl.score(res.model, valid).select("device_id", "label", "prediction")


@query("train_binary_lbfgs")
def _train_binary_lbfgs(ctx: JobContext) -> DataFrame:
    """ML-1/ML-5 binary by L-BFGS: validation predictions."""
    return _validated_lbfgs(_doc_labelled(ctx), 2, True)


@query("train_multiclass_lbfgs")
def _train_multiclass_lbfgs(ctx: JobContext) -> DataFrame:
    """ML-1/ML-5 multi-class by L-BFGS: validation predictions."""
    return _validated_lbfgs(_age_labelled(ctx), 5, False)


@query("model_weights")
def _model_weights(ctx: JobContext) -> DataFrame:
    """ML-1 of all eleven attributes: every non-zero coefficient, in 1e-9."""
    res = pipe.infer_all(ctx)
    weights = next(iter(res.results.values())).model
    out = None
    for name in res.results:
        one = weights.table(ctx.spark, name).where("class >= 0").select(
            F.lit(name).alias("attribute"), "class", "idx", "weight")
        out = one if out is None else out.unionByName(one)
    return out


@query("predict_unlabelled")
def _predict_unlabelled(ctx: JobContext) -> DataFrame:
    """ML-2: predicted quality of the documents without a label."""
    res = pipe.infer_documents(ctx)
    return res.output.where(F.col("is_predicted")).select("device_id", "label")


@query("infer_quality")
def _infer_quality(ctx: JobContext) -> DataFrame:
    """Documents job: known plus predicted quality per document."""
    return pipe.infer_documents(ctx).output


def _register_infer(attribute: str, ident: str) -> None:
    def fn(ctx: JobContext) -> DataFrame:
        return pipe.infer(ctx, attribute).output
    fn.__doc__ = f"{ident}: {attribute} job, known plus predicted labels."
    query(f"infer_{attribute}")(fn)


for _attr, _ident in (("gender", "PIPE-2"), ("age", "PIPE-3"), ("marital", "PIPE-4"),
                      ("parent", "PIPE-5"), ("child", "PIPE-6"), ("car", "PIPE-7"),
                      ("consumption", "PIPE-8"), ("estate", "PIPE-9"), ("income", "PIPE-10"),
                      ("education", "PIPE-11"), ("career", "PIPE-12")):
    _register_infer(_attr, _ident)


@query("sink_overwrite_partition")
def _sink_overwrite_partition(ctx: JobContext) -> DataFrame:
    """SNK-1: write two dates, overwrite the first again, read all back.

    Dynamic overwrite must leave the second date in place, so the result
    holds every feature row twice (once per date).
    """
    path = _scratch_dir(ctx, "sink")
    feats = ctx.features.persist()
    for d in (ctx.job_date, ctx.job_date + 1, ctx.job_date):
        sinks.overwrite_partitions(feats.withColumn("stat_date", F.lit(d)), path)
    feats.unpersist()
    return ctx.spark.read.parquet(path).select("device_id", "feature", "stat_date")


def _scratch_dir(ctx: JobContext, name: str) -> str:
    return delete_on_exit(ctx.spark, scratch_path(ctx.spark, f"{name}-{uuid.uuid4().hex}"))


@query("sink_published")
def _sink_published(ctx: JobContext) -> DataFrame:
    """SNK-1/SNK-3 as a published table: two dates, the first replaced, and a
    third attempt at it that writes but never publishes. Readers see the second."""
    path, feats = _scratch_dir(ctx, "published"), ctx.features.persist()
    dated = lambda d: feats.withColumn("stat_date", F.lit(d))
    publish.publish(dated(ctx.job_date).withColumn("feature", F.lit("old")), path, "first")
    publish.publish(dated(ctx.job_date + 1), path, "next")
    publish.publish(dated(ctx.job_date), path, "second")
    publish.stage(dated(ctx.job_date).withColumn("feature", F.lit("half")), path, "third")
    feats.unpersist()
    return publish.read_published(ctx.spark, path).select("device_id", "feature", "stat_date")


@query("sink_append_once")
def _sink_append_once(ctx: JobContext) -> DataFrame:
    """SNK-2: one run appended twice and another once, so every row is there twice."""
    path, feats = _scratch_dir(ctx, "appended"), ctx.features.persist()
    for run in ("a", "a", "b"):
        publish.publish(feats.withColumn("stat_date", F.lit(ctx.job_date)), path, run, append=True)
    feats.unpersist()
    return publish.read_published(ctx.spark, path).select("device_id", "feature", "stat_date")


@query("sink_fixed_files")
def _sink_fixed_files(ctx: JobContext) -> DataFrame:
    """SNK-4: the feature table as a fixed number of files per date."""
    path = _scratch_dir(ctx, "files")
    sinks.overwrite_partitions(ctx.features.withColumn("stat_date", F.lit(ctx.job_date)), path,
                               files=C.ORIGINAL_FILES_PER_PARTITION)
    rows = ctx.spark.read.parquet(path).select("stat_date", F.col("_metadata.file_name").alias("file"))
    return rows.groupBy("stat_date").agg(F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


@query("scan_via_view")
def _scan_via_view(ctx: JobContext) -> DataFrame:
    """SRC-5: the dated catalog rows through a temporary view."""
    return snap.via_view(cat.catalog_rows(ctx.view("app_catalog"), ctx.job_date), "catalog_of_the_day")


@query("model_saved_and_loaded")
def _model_saved_and_loaded(ctx: JobContext) -> DataFrame:
    """SNK-5: the gender model written, read back, and applied to the devices
    without a known label."""
    path, parsed = _scratch_dir(ctx, "models"), pipe.parsed_table(ctx.features)
    res = pipe.infer(ctx, "gender", model_dir=path, parsed=parsed).results["gender"]
    weights = exact.load(ctx.spark, res.model_path, exact.Target("gender", 2, "label"))
    ds = dsm.attach_labels(parsed, _gender(ctx)).where(~dsm.is_labelled())
    scored = exact.score(ds.select("device_id", "indices", "values"), weights)
    return scored.select("device_id", F.col("score_gender").alias("score"), F.col("prediction_gender").alias("label"))


@query("result_table")
def _result_table(ctx: JobContext) -> DataFrame:
    """SNK-6: two attribute jobs into one result table, read back."""
    path, parsed = _scratch_dir(ctx, "results"), pipe.parsed_table(ctx.features)
    for attribute in ("car", "child"):
        pipe.infer(ctx, attribute, out_dir=path, parsed=parsed)
    return ctx.spark.read.parquet(path).select("device_id", "attribute", "label", "is_predicted", "stat_date")


@query("infer_all")
def _infer_all(ctx: JobContext) -> DataFrame:
    """PIPE-2..12 together: one label pivot, one join, one scoring pass."""
    return pipe.infer_all(ctx).output


@query("doc_dataset_counts")
def _doc_dataset_counts(ctx: JobContext) -> DataFrame:
    """AGG-5 / FEAT-7 on documents: sizes of the documents job's data sets."""
    parsed = feat.parse(pipe.document_features(ctx))
    return dsm.counts(dsm.attach_labels(parsed, ctx.view("doc_labels")))


# --- queries whose bound or whose known part is checked --------------------------------


@query("features_encoded_topk")
def _features_encoded_topk(ctx: JobContext) -> DataFrame:
    """FEAT-2 with the top-K catalog, at a K that leaves items out."""
    return feat.encode(ctx.items("user_installs", C.ITEM_PREFIX, C.SMALL_K))


def _shuffled_items(ctx: JobContext, installs: DataFrame) -> DataFrame:
    """Items as encoded beyond the lookup bound: sketch of hot keys and shuffle join."""
    lookup = feat.lookup_for(ctx.catalog_ranked, C.ITEM_PREFIX, None)
    return feat.items_of(installs, ctx.job_date, lookup, max_lookup_rows=0)


@query("join_install_catalog_shuffled")
def _join_install_catalog_shuffled(ctx: JobContext) -> DataFrame:
    """JOIN-3 beyond the lookup bound: hot keys broadcast, cold ones joined by shuffle."""
    lookup = feat.lookup_for(ctx.catalog_ranked, C.ITEM_PREFIX, None)
    tokens = feat.install_tokens(feat.install_rows(ctx.view("user_installs"), ctx.job_date))
    return feat.match_catalog(tokens, lookup, max_broadcast_rows=0).select("device_id", "key", "idx")


@query("features_encoded_shuffled")
def _features_encoded_shuffled(ctx: JobContext) -> DataFrame:
    """FEAT-2 beyond the lookup bound: the same strings as within it."""
    return feat.encode(_shuffled_items(ctx, ctx.view("user_installs")))


@query("install_stats_repeated")
def _install_stats_repeated(ctx: JobContext) -> DataFrame:
    """FLT-10 / AGG-6 of an install table that holds every row twice, within
    and beyond the lookup bound."""
    installs = pipe.materialize_table(ctx.view("user_installs"), "installs")  # read four times
    twice = installs.unionAll(installs)
    lookup = feat.lookup_for(ctx.catalog_ranked, C.ITEM_PREFIX, None)
    local = feat.item_stats(feat.items_of(twice, ctx.job_date, lookup))
    beyond = feat.item_stats(_shuffled_items(ctx, twice))
    return local.withColumn("lookup", F.lit("local")).unionByName(beyond.withColumn("lookup", F.lit("shuffled")))


@query("doc_catalog_topk")
def _doc_catalog_topk(ctx: JobContext) -> DataFrame:
    """RNK-2 on the word catalog, which has more rows than TOP_K."""
    rows = cat.catalog_rows(ctx.view("doc_catalog"), ctx.job_date)
    return cat.top_k(cat.keep_max_installs(rows), C.TOP_K).select("appid", "app_name", "installnum", "idx")


@query("doc_catalog_topk_cut")
def _doc_catalog_topk_cut(ctx: JobContext) -> DataFrame:
    """RNK-2 beyond the merge bound: a histogram's cut-off, then candidates only."""
    rows = cat.catalog_rows(ctx.view("doc_catalog"), ctx.job_date)
    return cat.top_k(cat.keep_max_installs(rows), C.SMALL_K, max_merge_rows=0).select(
        "appid", "app_name", "installnum", "idx")


@query("doc_features_parsed")
def _doc_features_parsed(ctx: JobContext) -> DataFrame:
    """FEAT-5 / FLT-7 on documents: words beyond the dimension are left out."""
    p = feat.parse(pipe.document_features(ctx))
    return p.select("device_id", F.inline(F.arrays_zip(
        F.col("indices").alias("idx"), F.col("values").alias("value"))))


@query("feature_vectors")
def _feature_vectors(ctx: JobContext) -> DataFrame:
    """FEAT-6: the non-zero entries of every device's vector."""
    from pyspark.ml.functions import vector_to_array
    dense = pipe.vectors_from(ctx.features).select("device_id", vector_to_array("features").alias("v"))
    entries = F.array_compact(F.transform("v", lambda x, i: F.when(
        x != 0, F.struct(i.alias("idx"), x.alias("value")))))
    return dense.select("device_id", F.inline(entries))


@query("union_distribution")
def _union_distribution(ctx: JobContext) -> DataFrame:
    """AGG-3 over SET-1: classes of known and predicted labels together."""
    return lbl.distribution(REGISTRY["union_known_predicted"](ctx.spark, ctx.sf_dir))


def _known_part(ctx: JobContext, parsed: DataFrame, labels: dict[str, DataFrame]) -> DataFrame:
    """The part of a job's output that no model decides: its devices, their
    known labels, and which labels are left to predict."""
    out = None
    for name, known in labels.items():
        ds = dsm.attach_labels(parsed.select("device_id"), known)
        one = ds.select("device_id", F.lit(name).alias("attribute"),
                        F.when(dsm.is_labelled(), F.col("label")).alias("label"),
                        (~dsm.is_labelled()).alias("is_predicted"))
        out = one if out is None else out.unionByName(one)
    return out


def _register_known(attribute: str) -> None:
    def fn(ctx: JobContext) -> DataFrame:
        return _known_part(ctx, ctx.parsed, {attribute: pipe.known_labels(ctx, attribute)})
    fn.__doc__ = f"SET-1: the {attribute} job's devices, known labels and which ones are predicted."
    query(f"infer_{attribute}_known")(fn)


for _attr in pipe.ATTRIBUTES:
    _register_known(_attr)


@query("infer_all_known")
def _infer_all_known(ctx: JobContext) -> DataFrame:
    """SET-1 of the all-attribute job: known labels from the label matrix."""
    wide = pipe.materialize(pipe.label_matrix(ctx, list(pipe.ATTRIBUTES)))
    cols = [f"label_{a}" for a in pipe.ATTRIBUTES]
    ds = dsm.attach_labels(ctx.parsed.select("device_id"), wide, cols)
    return ds.select("device_id", F.inline(F.array(*[F.struct(
        F.lit(a).alias("attribute"), F.when(dsm.is_labelled(c), F.col(c)).alias("label"),
        (~dsm.is_labelled(c)).alias("is_predicted")) for a, c in zip(pipe.ATTRIBUTES, cols)])))


@query("infer_quality_known")
def _infer_quality_known(ctx: JobContext) -> DataFrame:
    """SET-1 of the documents job: known labels and which ones are predicted."""
    return _known_part(ctx, feat.parse(pipe.document_features(ctx)), {"quality": ctx.view("doc_labels")})
