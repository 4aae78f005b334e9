"""Published tables: all or nothing, appended once, replaced in one step."""

import pytest
from pyspark.sql import functions as F

from traitlab.plans import pipelines as pipe
from traitlab.sources import publish as pub


def table(spark, tag, dates=(1, 2), n=10):
    return spark.range(n).withColumn("tag", F.lit(tag)).withColumn(
        "stat_date", F.element_at(F.array(*[F.lit(d) for d in dates]), (F.col("id") % len(dates) + 1).cast("int")))


def counts(spark, path):
    rows = pub.read_published(spark, path).groupBy("stat_date", "tag").count().collect()
    return {(r["stat_date"], r["tag"]): r["count"] for r in rows}


def test_replaces_only_its_partitions(spark, scratch):
    pub.publish(table(spark, "a"), scratch, "r1")
    pub.publish(table(spark, "b", (2, 3)), scratch, "r2")
    assert counts(spark, scratch) == {(1, "a"): 5, (2, "b"): 5, (3, "b"): 5}
    assert pub.read_published(spark, scratch).columns == ["id", "tag", "stat_date"]
    # a plain reader sees no half-published files at all
    assert pub.prune(spark, scratch) == [] and counts(spark, scratch)[1, "a"] == 5
    pub.publish(table(spark, "c"), scratch, "r3")
    assert pub.prune(spark, scratch) == ["r1"]
    assert counts(spark, scratch) == {(1, "c"): 5, (2, "c"): 5, (3, "b"): 5}


def test_a_failure_before_publishing_leaves_the_old_date(spark, scratch, monkeypatch):
    pub.publish(table(spark, "a"), scratch, "r1")
    monkeypatch.setattr(pub._Store, "claim", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        pub.publish(table(spark, "b"), scratch, "r2")
    monkeypatch.undo()
    assert counts(spark, scratch) == {(1, "a"): 5, (2, "a"): 5}
    # an attempt that died while writing: files there, never named
    pub.stage(table(spark, "c", n=4), scratch, "r3")
    assert counts(spark, scratch) == {(1, "a"): 5, (2, "a"): 5}
    pub.publish(table(spark, "c"), scratch, "r3")               # the same run again starts afresh
    assert counts(spark, scratch) == {(1, "c"): 5, (2, "c"): 5}


def test_rows_lost_while_writing_are_noticed(spark, scratch, monkeypatch):
    monkeypatch.setattr(pub, "_shape", lambda df, *a: df.where("id <> 3"))
    with pytest.raises(pub.PublishError, match="9 of 10 rows"):
        pub.publish(table(spark, "a"), scratch, "r1")
    assert not pub.is_published(spark, scratch)


def test_append_is_idempotent_per_run(spark, scratch):
    assert len(pub.publish(table(spark, "a"), scratch, "r1", append=True)) == 2
    assert pub.publish(table(spark, "a"), scratch, "r1", append=True) == []
    assert counts(spark, scratch) == {(1, "a"): 5, (2, "a"): 5}
    pub.publish(table(spark, "a"), scratch, "r2", append=True)
    assert counts(spark, scratch) == {(1, "a"): 10, (2, "a"): 10}
    # a run that comes back with one more date adds that date only
    assert pub.publish(table(spark, "a", (1, 9)), scratch, "r1", append=True) == [(["9"], 5)]
    assert counts(spark, scratch) == {(1, "a"): 10, (2, "a"): 10, (9, "a"): 5}
    with pytest.raises(ValueError, match="is published"):
        pub.publish(table(spark, "a"), scratch, "r1")


def test_two_writers_both_get_in(spark, scratch, monkeypatch):
    """The writer that loses a version reads the winner's and goes on from it."""
    plain, turn = pub._Store.claim, []

    def claim(self, source, target):
        if not turn:
            turn.append(1)
            pub.publish(table(spark, "b", (5,)), scratch, "other")
        return plain(self, source, target)

    monkeypatch.setattr(pub._Store, "claim", claim)
    pub.publish(table(spark, "a", (4,)), scratch, "one")
    assert counts(spark, scratch) == {(4, "a"): 10, (5, "b"): 10}
    assert not [n for n in pub._Store(spark, scratch).names("_manifest") if n.startswith(".") and not n.endswith(".crc")]


def test_odd_values_empty_tables_and_names(spark, scratch):
    df = spark.createDataFrame([(1, "a b/c"), (2, None), (3, "x=y:z"), (4, "07")], "id int, part string")
    pub.publish(df, scratch, "r.1-a", ("part",))
    assert sorted(map(tuple, pub.read_published(spark, scratch).collect())) == sorted(map(tuple, df.collect()))
    assert pub.publish(df.limit(0), scratch, "r2", ("part",)) == []
    assert pub.read_published(spark, scratch).count() == 4
    for bad in ("", "_x", "a/b", "../a"):
        with pytest.raises(ValueError, match="run id"):
            pub.publish(df, scratch, bad, ("part",))
    with pytest.raises(ValueError, match="partitioned by"):
        pub.publish(df, scratch, "r3", ("id",))
    with pytest.raises(ValueError, match="nothing is published"):
        pub.read_published(spark, scratch + "/none")


def test_jobs_publish_under_a_run_id(spark, scratch, ctx001):
    from traitlab.__main__ import main
    base = ["--date", "20180709", "--input", "/root/testdata/sf0.001"]
    assert main(["features", *base, "--out", scratch, "--run-id", "f1"]) == 0
    feats = pipe.read_features(spark, f"{scratch}/features", 20180709)
    assert sorted(map(tuple, feats.collect())) == sorted(map(tuple, ctx001.features.collect()))
    job = ["infer", *base, "--attribute", "car", "--features", f"{scratch}/features", "--out", f"{scratch}/labels",
           "--max-iter", "3", "--append"]
    for run in ("a", "a", "b"):
        assert main([*job, "--run-id", run]) == 0
    assert pub.read_published(spark, f"{scratch}/labels").count() == 2 * feats.count()
