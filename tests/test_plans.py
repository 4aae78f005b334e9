"""Physical-plan checks: the shapes the design relies on."""

from traitlab.operators import dataset as dsm
from traitlab.plans import pipelines as pipe
from traitlab.plans.context import JobContext
from traitlab.plans.queries import REGISTRY
from traitlab.sources.snapshot import dated_scan

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_install_lookup_is_row_local(spark):
    p = plan(REGISTRY["features_encoded"](spark, SF))
    assert "MapInArrow" in p and "Generate" not in p
    assert "BatchEvalPython" not in p


def test_size_check_sends_no_rows_to_one_task(spark, ctx001):
    from traitlab.operators import sizing
    rows, size = sizing.measured(ctx001.view("device_rel"))
    assert rows == ctx001.view("device_rel").count() and size > 8 * rows
    assert not sizing.small(ctx001.view("device_rel"), rows - 1)
    assert not sizing.small(ctx001.view("device_rel"), rows, size - 1)


def test_labels_are_joined_before_vectors(spark):
    ctx = JobContext(spark, SF)
    parsed = pipe.parsed_table(ctx.features)
    from traitlab.operators import dataset as dsm
    from traitlab.operators import features as feat
    p = plan(feat.vectorize(dsm.attach_labels(parsed, pipe.known_labels(ctx, "gender")), values="binary"))
    assert p.index("UDF(") < p.index("Join") and p.count("Scan parquet") - p.count("Scan parquet file") >= 1


def test_topk_uses_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(REGISTRY["catalog_topk"](spark, SF))


def test_parse_is_shuffle_free(spark):
    ctx = JobContext(spark, SF)
    p = plan(pipe.vectors_from(pipe.materialize(ctx.features)))
    assert "Exchange" not in p
    assert "BatchEvalPython" not in p


def test_dated_scan_prunes_partitions(spark, scratch):
    ctx = JobContext(spark, SF)
    pipe.build_features(ctx, out_dir=scratch)
    df = dated_scan(spark.read.parquet(f"{scratch}/features"), 20180709, ["device_id", "feature"])
    p = plan(df)
    assert "PartitionFilters: [isnotnull(stat_date" in p and "= 20180709" in p


def test_questionnaire_labels_single_shuffle(spark):
    p = plan(REGISTRY["labels_long"](spark, SF))
    assert p.count("Exchange hashpartitioning(attribute") == 1


def test_label_matrix_one_shuffle_one_account_join(spark):
    ctx = JobContext(spark, SF)
    p = plan(pipe.label_matrix(ctx, list(pipe.ATTRIBUTES)))
    # the only hash exchange is the device aggregate (joins may broadcast)
    assert p.count("Exchange hashpartitioning(device_id") == 1
    assert p.count("Exchange hashpartitioning(attribute") == 0
    # gender and age have device relations of their own
    assert p.count("HashJoin") + p.count("SortMergeJoin") == 2


def test_bucketed_features_join_without_exchange(spark, scratch, ctx001):
    """Labels beyond the broadcast bound: only they move, into the features' buckets."""
    import uuid
    table = f"features_{uuid.uuid4().hex}"
    pipe.feature_table(ctx001, table, buckets=6, path=f"{scratch}/t")
    pipe.feature_table(ctx001, table, buckets=6)              # the same date again replaces it
    assert spark.table(table).count() == ctx001.features.count()
    parsed = pipe.read_feature_table(spark, table, ctx001.job_date)
    labels = pipe.known_labels(ctx001, "gender")
    labels.write.parquet(f"{scratch}/labels")
    labels = spark.read.parquet(f"{scratch}/labels")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = dsm.attach_labels(parsed, labels, max_broadcast_rows=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange ") == 1
        assert "Bucketed: true" in plan and plan.index("Bucketed: true") < plan.index("Exchange ")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    expected = dsm.attach_labels(ctx001.parsed, labels)
    rows = lambda df: sorted(map(tuple, df.select("device_id", "indices", "values", "label").collect()))
    assert rows(joined) == rows(expected)
    out = pipe.infer(ctx001, "gender", parsed=parsed, max_iter=5).output
    plain = pipe.infer(ctx001, "gender", max_iter=5).output
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
