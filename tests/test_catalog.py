import numpy as np
from pyspark.sql import Window, functions as F

from traitlab.operators import catalog as cat
from traitlab.operators.ordering import global_index, running_totals


def _catalog(spark):
    rows = [("a", "x", 5), ("a", "y", 9), ("a", "b", 9), ("b", "n", 9), ("c", "m", 1),
            ("d", "k", 3), ("e", None, 100), (None, "z", 50), ("f", "f", None)]
    return spark.createDataFrame(rows, "appid string, app_name string, installnum bigint") \
        .withColumn("stat_date", F.lit(20180709))


def test_keep_max_installs_ties_take_smallest_name(spark):
    rows = cat.catalog_rows(_catalog(spark), 20180709)
    got = {r["appid"]: (r["app_name"], r["installnum"]) for r in cat.keep_max_installs(rows).collect()}
    assert got == {"a": ("b", 9), "b": ("n", 9), "c": ("m", 1), "d": ("k", 3)}


def test_rank_is_total_order_installs_desc_then_id(spark):
    dedup = cat.keep_max_installs(cat.catalog_rows(_catalog(spark), 20180709))
    got = [(r["appid"], r["idx"]) for r in cat.rank_catalog(dedup).orderBy("idx").collect()]
    assert got == [("a", 0), ("b", 1), ("d", 2), ("c", 3)]


def test_top_k(spark):
    dedup = cat.keep_max_installs(cat.catalog_rows(_catalog(spark), 20180709))
    got = [(r["appid"], r["idx"]) for r in cat.top_k(dedup, 2).orderBy("idx").collect()]
    assert got == [("a", 0), ("b", 1)]


def test_global_index_matches_window_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("u"))
    order = [F.col("k").desc(), F.col("u").asc()]
    ours = global_index(df, order, "idx", partitions=7)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(*order)) - 1)
    j = ours.join(ref, ["k", "u"])
    assert j.count() == 5000
    assert j.where(F.col("idx") != F.col("ref")).count() == 0
    assert ours.agg(F.min("idx"), F.max("idx")).first()[:] == (0, 4999)


def test_running_totals_match_python(spark):
    data = [(float(i % 13), i % 3, 1) for i in range(300)]
    df = spark.createDataFrame(data, "s double, a int, b int").groupBy("s").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    out = running_totals(df, [F.col("s").desc()], ["a", "b"], partitions=5).collect()
    rows = sorted(((r["s"], r["a"], r["b"], r["cum_a"], r["cum_b"]) for r in out), reverse=True)
    ca = cb = 0
    for s, a, b, cum_a, cum_b in rows:
        ca += a
        cb += b
        assert (cum_a, cum_b) == (ca, cb)


def test_top_k_merge_and_index_paths_agree(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("string").alias("appid"),
                                     F.lit("n").alias("app_name"),
                                     (F.col("id") % 50).alias("installnum"))
    a = [tuple(r) for r in cat.top_k(df, 120).orderBy("idx").collect()]
    b = [tuple(r) for r in cat.top_k(df, 120, max_merge_rows=0).select(*df.columns, "idx")
         .orderBy("idx").collect()]
    assert a == b and len(a) == 120 and a[0][3] == 0


def test_cut_off_keeps_the_top_and_few_more(spark):
    """Heavy tails, ties across the cut, more than there is, negative and no values."""
    rng = np.random.default_rng(2)
    for values, k in [(rng.zipf(1.4, 3000) % 10**12, 50), (np.repeat([5, 5, 9, 1], 400), 900), (np.arange(10), 30),
                      (np.array([-7, 0, 10**15, 3]), 2), (np.full(500, 8), 3)]:
        rows = spark.createDataFrame([(int(v),) for v in values], "installnum long")
        least = cat.cut_off(rows, k, buckets=16)
        kth = sorted(values)[-min(k, len(values))]
        assert least <= kth
        assert (values >= least).sum() <= max(2 * k, (values >= kth).sum())
    assert cat.cut_off(spark.createDataFrame([], "installnum long"), 3) is None


def test_top_k_sorts_candidates_only(spark, monkeypatch):
    """Beyond the merge bound only rows above the cut-off reach the range sort."""
    rows = [(str(i), f"n{i}", i % 997) for i in range(4000)]
    df = spark.createDataFrame(rows, "appid string, app_name string, installnum bigint").repartition(5)
    seen = []
    plain = cat.global_index
    monkeypatch.setattr(cat, "global_index", lambda d, *a: (seen.append(d.count()), plain(d, *a))[1])
    got = [tuple(r) for r in cat.top_k(df, 25, max_merge_rows=0).orderBy("idx").collect()]
    expected = sorted(rows, key=lambda r: (-r[2], r[0]))[:25]
    assert got == [(*r, i) for i, r in enumerate(expected)]
    assert 25 <= seen[0] <= 50
    assert cat.top_k(df.limit(0), 5, max_merge_rows=0).count() == 0
