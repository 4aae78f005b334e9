import json

from pyspark.sql import functions as F

from traitlab.plans import pipelines as pipe
from traitlab.plans.context import JobContext
from traitlab.sources.snapshot import dated_scan


def test_build_features_writes_dated_partitions(spark, scratch):
    ctx = JobContext(spark, "/root/testdata/sf0.001")
    fb = pipe.build_features(ctx, out_dir=scratch)
    n = fb.features.count()
    other = JobContext(spark, "/root/testdata/sf0.001", job_date=20180710)
    # the derived inputs carry stat_date 20180709 only, so write the other date directly
    from traitlab.sources import sinks
    sinks.overwrite_partitions(fb.features.withColumn("stat_date", F.lit(other.job_date)),
                               f"{scratch}/features")
    pipe.build_features(ctx, out_dir=scratch)          # re-run of the first date
    back = spark.read.parquet(f"{scratch}/features")
    counts = {r["stat_date"]: r["count"] for r in back.groupBy("stat_date").count().collect()}
    assert counts == {20180709: n, 20180710: n}
    cat = spark.read.parquet(f"{scratch}/catalog")
    assert dated_scan(cat, 20180709, ["appid", "idx"]).count() == fb.catalog.count()


def test_fixed_file_count(spark, scratch):
    from traitlab.sources import sinks
    df = spark.range(100).withColumn("stat_date", F.lit(1))
    sinks.overwrite_partitions(df, scratch, files=3)
    import glob
    assert len(glob.glob(f"{scratch}/stat_date=1/*.parquet")) == 3


def test_append_duplicates_date(spark, scratch):
    from traitlab.sources import sinks
    df = spark.range(10).withColumn("stat_date", F.lit(1))
    sinks.append_partitions(df, scratch)
    sinks.append_partitions(df, scratch)
    assert spark.read.parquet(scratch).count() == 20


def test_infer_output_invariants(ctx001):
    res = pipe.infer(ctx001, "gender")
    out = res.output
    rows = out.collect()
    devs = [r["device_id"] for r in rows]
    assert len(devs) == len(set(devs))
    parsed = {r["device_id"] for r in ctx001.parsed.collect()}
    assert set(devs) == parsed
    known = {r["device_id"]: r["label"] for r in pipe.known_labels(ctx001, "gender").collect()}
    for r in rows:
        if not r["is_predicted"]:
            assert known[r["device_id"]] == r["label"]
        else:
            assert r["device_id"] not in known
        assert r["label"] in (0.0, 1.0)
        assert r["attribute"] == "gender" and r["stat_date"] == 20180709


def test_infer_all_matches_known_labels(ctx001):
    attrs = ["gender", "child", "income"]
    res = pipe.infer_all(ctx001, attrs)
    rows = res.output.collect()
    parsed = {r["device_id"] for r in ctx001.parsed.collect()}
    assert len(rows) == len(parsed) * len(attrs)
    for a in attrs:
        known = {r["device_id"]: r["label"] for r in pipe.known_labels(ctx001, a).collect()}
        mine = [r for r in rows if r["attribute"] == a]
        for r in mine:
            if r["is_predicted"]:
                assert r["device_id"] not in known
            else:
                assert known[r["device_id"]] == r["label"]
        assert {r["label"] for r in mine} <= set(float(k) for k in range(pipe.ATTRIBUTES[a].classes))


def test_feature_job_then_attribute_job_from_table(spark, scratch):
    from traitlab.__main__ import main
    assert main(["features", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--out", scratch]) == 0
    for t in ("catalog", "features", "features_push"):
        assert spark.read.parquet(f"{scratch}/{t}").where("stat_date = 20180709").count() > 0
    # a lenient date: 20180640 is 20180710, a date the features table does not hold
    import pytest
    with pytest.raises(ValueError, match="no labelled training rows for car on 20180710"):
        main(["infer", "--date", "20180640", "--input", "/root/testdata/sf0.001",
              "--attribute", "car", "--features", f"{scratch}/features"])
    assert main(["infer", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--attribute", "car", "--features", f"{scratch}/features",
                 "--out", f"{scratch}/attrs", "--models", f"{scratch}/models"]) == 0
    out = spark.read.parquet(f"{scratch}/attrs")
    ctx = JobContext(spark, "/root/testdata/sf0.001")
    assert out.where("attribute = 'car' and stat_date = 20180709").count() == ctx.parsed.count()
    import os
    assert os.path.isdir(f"{scratch}/models/car/20180709")


def test_cli_infer_all_from_features_table(spark, scratch):
    from traitlab.__main__ import main
    assert main(["features", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--out", scratch]) == 0
    assert main(["infer-all", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--features", f"{scratch}/features", "--out", f"{scratch}/attrs"]) == 0
    out = spark.read.parquet(f"{scratch}/attrs").where("stat_date = 20180709")
    per_attr = {r["attribute"]: r["count"] for r in out.groupBy("attribute").count().collect()}
    assert set(per_attr) == set(pipe.ATTRIBUTES)
    assert len(set(per_attr.values())) == 1          # every attribute covers every device


def test_cli_infer_training_options(spark, scratch, capsys):
    from traitlab.__main__ import main
    assert main(["infer", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--attribute", "gender", "--out", f"{scratch}/attrs", "--max-iter", "5",
                 "--reg-param", "0.1", "--fit-intercept", "--holdout-percent", "10"]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert 0.0 <= printed["result"]["gender"]["report"]["auc"] <= 1.0
    out = spark.read.parquet(f"{scratch}/attrs").where("stat_date = 20180709")
    assert {r["attribute"] for r in out.select("attribute").distinct().collect()} == {"gender"}


def test_materialize_table_round_trip_and_pruning(spark, ctx001):
    feats = pipe.materialize_table(ctx001.features, "features")
    assert sorted(map(tuple, feats.collect())) == sorted(map(tuple, ctx001.features.collect()))
    p = feats.select("device_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<device_id:string>" in p


def test_date_without_rows(spark, scratch):
    import pytest
    ctx = JobContext(spark, "/root/testdata/sf0.001", 20990101)
    report = pipe.feature_job(ctx, scratch)
    assert report["n_catalog"] == 0 and report["n_total"] == 0
    assert report["min_items"] is None and report["max_items"] is None
    with pytest.raises(ValueError, match="no labelled training rows"):
        pipe.infer(ctx, "gender")


def test_cli_removes_its_intermediate_tables(spark, scratch):
    import os
    from traitlab.__main__ import main
    from traitlab.session import scratch_path
    tables = scratch_path(spark, "").replace("file:", "")
    pipe.materialize_table(spark.range(3), "probe")
    assert os.path.isdir(tables)
    assert main(["infer", "--date", "20180709", "--input", "/root/testdata/sf0.001",
                 "--attribute", "gender", "--out", f"{scratch}/attrs"]) == 0
    assert not os.path.exists(tables)
    assert spark.read.parquet(f"{scratch}/attrs").count() > 0


def test_inputs_by_name_and_another_date(spark, scratch):
    """The jobs read named Parquet inputs of any date, and append on demand."""
    from pyspark.sql import functions as F
    sample = JobContext(spark, "/root/testdata/sf0.001")
    views = ("app_catalog", "user_installs", "user_installs_push", "users_info", "device_rel")
    for v in views:
        (sample.view(v).where("stat_date = 20180709").withColumn("stat_date", F.lit(20200101))
         .write.parquet(f"{scratch}/{v}"))
    ctx = JobContext(spark, None, 20200101, {v: f"{scratch}/{v}" for v in views})
    stats = pipe.feature_job(ctx, f"{scratch}/out")
    features = pipe.read_features(spark, f"{scratch}/out/features", 20200101)
    assert stats["n_refined"] == features.count() > 0
    expected = sorted((r["device_id"], r["feature"]) for r in sample.features.collect())
    assert sorted((r["device_id"], r["feature"]) for r in features.collect()) == expected
    for _ in range(2):
        pipe.infer(ctx, "gender", features, f"{scratch}/labels", append=True, max_iter=1)
    rows = spark.read.parquet(f"{scratch}/labels")
    assert rows.count() == 2 * rows.distinct().count() == 2 * features.count()
