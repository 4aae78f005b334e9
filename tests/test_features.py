import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from traitlab.operators import catalog as cat
from traitlab.operators import features as feat
from traitlab.operators import lookup


def _ranked(spark):
    rows = [("1", "one", 10), ("2", "two words", 8), ("3", "c:pro", 6), ("4", "four", 4)]
    df = spark.createDataFrame(rows, "appid string, app_name string, installnum bigint")
    return cat.rank_catalog(cat.keep_max_installs(df))


def _installs(spark):
    rows = [("d1", "111:1 113:1 119:1 111:1"), ("d2", "115:1 116:1"),
            ("d3", "114:1 112:3 "), (None, "111:1"), ("d4", None)]
    return spark.createDataFrame(rows, "device_id string, value string") \
        .withColumn("stat_date", F.lit(20180709))


def _items(spark, **join_opts):
    lookup = feat.lookup_for(_ranked(spark), "11", None)
    tokens = feat.install_tokens(feat.install_rows(_installs(spark), 20180709))
    return feat.device_items(tokens, lookup, **join_opts)


def test_encode_orders_by_index_and_drops_unknown_items(spark):
    got = {r["device_id"]: r["feature"] for r in feat.encode(_items(spark)).collect()}
    assert got == {
        "d1": "[111_one]_wind_0:1 [113_c:pro]_wind_2:1",
        "d3": "[112_two words]_wind_1:1 [114_four]_wind_3:1",
    }


def test_coverage_and_length_stats(spark):
    items = _items(spark)
    c = feat.coverage(items).first()
    assert (c["n_total"], c["n_empty"], c["n_refined"]) == (3, 1, 2)
    s = feat.length_stats(items).first()
    assert (s["min_items"], s["max_items"]) == (2, 2)
    both = feat.item_stats(items).first().asDict()
    assert both == {"n_total": 3, "n_empty": 1, "n_refined": 2, "min_items": 2, "max_items": 2}


def test_length_stats_empty_is_null(spark):
    empty = spark.createDataFrame([("x", [])], "device_id string, items array<struct<idx:bigint,token:string>>")
    s = feat.length_stats(empty).first()
    assert (s["min_items"], s["max_items"]) == (None, None)


def test_shuffle_join_equals_broadcast_join(spark):
    a = sorted((r["device_id"], r["feature"]) for r in feat.encode(_items(spark)).collect())
    b = sorted((r["device_id"], r["feature"]) for r in
               feat.encode(_items(spark, max_broadcast_rows=0)).collect())
    assert a == b


def test_top_k_restricts_lookup(spark):
    lookup = feat.lookup_for(_ranked(spark), "11", 2)
    assert sorted(r["key"] for r in lookup.collect()) == ["111", "112"]


def test_parse_token_grammar(spark):
    rows = [
        ("d1", "[111_one]_wind_0:1 [113_c:pro]_wind_2:1"),
        ("d3", "[112_two words]_wind_1:1 [114_four]_wind_3:1"),
        ("e", "a_wind_5:1 b_wind_12:1 c_wind_-1:1 d_wind_x:1 e_wind_3:2.5 f_wind_4:abc"),
        ("t", "x_wind_7:1:: y_wind_8_wind_:1 z_wind__wind_9:1 w_wind_q_wind_6:1 :1 _wind_2:1"),
        ("none", "nothing:1 here"),
    ]
    df = spark.createDataFrame(rows, "device_id string, feature string")
    got = {r["device_id"]: (r["indices"], r["values"]) for r in feat.parse(df, dim=10).collect()}
    assert got == {
        "d1": ([0], [1.0]),
        "d3": ([1, 3], [1.0, 1.0]),
        "e": ([5, 3], [1.0, 2.5]),
        "t": ([7, 8, 2], [1.0, 1.0, 1.0]),
    }


def test_vectorize_binary_and_general(spark):
    df = spark.createDataFrame([("a", [3, 1, 3], [1.0, 1.0, 1.0]), ("b", [4, 2], [2.5, 1.0]),
                                ("c", [5, 2, 5, 0], [0.5, 1.0, 0.25, -2.0])],
                               "device_id string, indices array<int>, values array<double>")
    got = {r["device_id"]: r["features"] for r in feat.vectorize(df, dim=6).collect()}
    assert got["a"] == SparseVector(6, [1, 3], [1.0, 1.0])
    assert got["b"] == SparseVector(6, [2, 4], [1.0, 2.5])
    # general branch (pandas UDF): repeated indexes are summed, indexes sorted
    assert got["c"] == SparseVector(6, [0, 2, 5], [-2.0, 1.0, 0.75])


def test_hot_item_join_keeps_every_row(spark):
    # one item sits in a third of all install lists
    rows = [(f"d{i}", "111:1" if i % 3 == 0 else f"11{2 + i % 3}:1 111:1") for i in range(300)]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709))
    lookup = feat.lookup_for(_ranked(spark), "11", None)
    tokens = feat.install_tokens(feat.install_rows(installs, 20180709))
    a = feat.match_catalog(tokens, lookup)
    b = feat.match_catalog(tokens, lookup, max_broadcast_rows=0)
    key = lambda df: sorted((r["device_id"], r["key"], r["idx"]) for r in df.collect())
    assert key(a) == key(b)
    assert len(key(b)) == 100 + 200 * 2


def test_hot_keys_are_found_and_bounded(spark, monkeypatch):
    """A key in a third of all tokens is sent to the tasks; the catalog is not replicated."""
    rows = [(f"d{i}", "111" if i % 3 == 0 else f"x{i}") for i in range(9000)] + [("n", None)]
    tokens = spark.createDataFrame(rows, "device_id string, key string").repartition(7)
    monkeypatch.setattr(feat.C, "HOT_KEYS", 50)
    monkeypatch.setattr(feat.C, "HOT_KEYS_TRACKED", 200)
    hot = feat.hot_keys(tokens)
    assert "111" in hot and len(hot) <= 50
    assert feat.hot_keys(tokens.limit(0)) == []
    lookup = spark.range(12000).select(F.concat(F.lit("x"), "id").alias("key"), F.col("id").alias("idx"),
                                       F.lit("t").alias("token")).unionByName(
        spark.createDataFrame([("111", -1, "t")], "key string, idx long, token string"))
    for how, n in (("inner", 9000), ("left", 9001)):
        out = feat.match_catalog(tokens, lookup, how, max_broadcast_rows=0)
        assert out.count() == n and out.where("idx = -1").count() == 3000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "explode" not in plan      # no replicated rows
    few = feat.match_catalog(tokens.where("key <> '111'").limit(40), lookup, max_broadcast_rows=0)
    assert few.count() == 40


def test_key_index_finds_exactly_its_keys():
    rng = np.random.default_rng(5)
    keys = ["", "a", "b", "ab", "ba", "é", "漢字", "k" * 5000] + [f"11{i}" for i in range(3000)]
    index = lookup.KeyIndex(pa.chunked_array([keys[:10], keys[10:]]))
    asked = [keys[i] if i < len(keys) else f"no{i}" for i in rng.integers(0, 2 * len(keys), 5000)] + [None, "", "aa"]
    place = {k: i for i, k in enumerate(keys)}
    expected = [-1 if x is None else place.get(x, -1) for x in asked]
    assert index.find(pa.array(asked)).tolist() == expected
    assert index.find(pa.array(asked)[7:90]).tolist() == expected[7:90]
    assert lookup.KeyIndex(pa.array([], pa.string())).find(pa.array(["x"])).tolist() == [-1]
    assert index.find(pa.array([], pa.string())).tolist() == []


def test_key_index_separates_keys_of_one_hash(monkeypatch):
    """Keys that share a hash under one multiplier get the next one."""
    plain = lookup._hashed
    monkeypatch.setattr(lookup, "_hashed", lambda s, m: plain(s, m) * np.uint64(m != lookup._MULTIPLIERS[0]))
    index = lookup.KeyIndex(pa.array(["a", "b"]))
    assert index.multiplier == lookup._MULTIPLIERS[1] and index.find(pa.array(["b", "c", "a"])).tolist() == [1, -1, 0]
    with pytest.raises(ValueError, match="not distinct"):
        lookup.KeyIndex(pa.array(["a", "a"]))


def test_batches_cost_what_their_strings_cost():
    """Two hundred times the keys, the same batch: far from two hundred times the time."""
    batch = pa.array([f"key{i * 37 % 500_000}" for i in range(20_000)])
    took = []
    for n in (2_000, 400_000):
        index = lookup.KeyIndex(pa.array([f"key{i}" for i in range(n)]))
        index.find(batch)
        t0 = time.perf_counter()
        for _ in range(5):
            index.find(batch)
        took.append(time.perf_counter() - t0)
    assert took[1] < 20 * took[0]


def test_repeated_and_empty_rows_give_one_result_at_every_lookup_size(spark):
    """Rows that are alike stay rows of their own, also beyond the bound."""
    rows = [("d1", "111:1 113:1"), ("d1", "111:1 113:1"), ("d1", "113:1 111:1"), ("d1", "114:1"), ("d2", ""),
            ("d2", ""), ("d2", "  "), ("d3", "119:1"), ("d3", "119:1"), ("d4", "112")]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709)).repartition(4)
    names = feat.lookup_for(_ranked(spark), "11", None)
    local = feat.items_of(installs, 20180709, names)
    shuffled = feat.items_of(installs, 20180709, names, max_lookup_rows=0)
    key = lambda df: sorted((r["device_id"], [tuple(i) for i in r["items"]]) for r in df.collect())
    assert key(local) == key(shuffled) and len(key(local)) == len(rows)
    for df in (local, shuffled):
        assert feat.item_stats(df).first().asDict() == {
            "n_total": 10, "n_empty": 5, "n_refined": 5, "min_items": 1, "max_items": 2}
    features = lambda df: sorted(tuple(r) for r in feat.encode(df).collect())
    assert features(local) == features(shuffled) and len(features(local)) == 5


def test_row_items_equal_shuffled_items(spark):
    rows = [("d1", "111:1 113:1 119:1 111:1"), ("d1", "114:1"), ("d2", "115:1 116:1"),
            ("d3", "114:1 112:3 "), (None, "111:1"), ("d4", None), ("d5", "")]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709))
    lookup = feat.lookup_for(_ranked(spark), "11", None)
    local = feat.items_of(installs, 20180709, lookup)
    shuffled = feat.items_of(installs, 20180709, lookup, max_lookup_rows=0)
    key = lambda df: sorted((r["device_id"], [tuple(i) for i in r["items"]]) for r in df.collect())
    assert key(local) == key(shuffled)
    # one result per install row: d1 has two
    assert [d for d, _ in key(local)] == ["d1", "d1", "d2", "d3", "d5"]


def test_row_items_without_exchange(spark, scratch):
    _installs(spark).write.parquet(f"{scratch}/installs")
    lookup = feat.lookup_for(_ranked(spark), "11", None)
    out = feat.encode(feat.items_of(spark.read.parquet(f"{scratch}/installs"), 20180709, lookup))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_vectors_route_rows_by_raw_values(spark):
    rows = [("a", "[1_x]_wind_1:1 [2_y]_wind_3:1"), ("b", "[1_x]_wind_1:1 [2_y]_wind_3:2.5"),
            ("c", "[1_x:pro]_wind_2:1 [3_z]_wind_4:1"), ("d", "nothing here")]
    df = spark.createDataFrame(rows, "device_id string, feature string")
    got = {r["device_id"]: r["features"] for r in feat.vectors(df, dim=6).collect()}
    assert got == {"a": SparseVector(6, [1, 3], [1.0, 1.0]),
                   "b": SparseVector(6, [1, 3], [1.0, 2.5]),
                   "c": SparseVector(6, [4], [1.0])}
    unit = ~F.col("feature").rlike(feat._NON_UNIT_VALUE)
    flags = {r["device_id"]: r["u"] for r in df.select("device_id", unit.alias("u")).collect()}
    assert flags == {"a": True, "b": False, "c": False, "d": True}


def test_vectors_long_strings(spark):
    text = " ".join(f"[w{i}_w{i}]_wind_{i % 30000}:1" for i in range(40000))
    df = spark.createDataFrame([("long", text)], "device_id string, feature string")
    v = feat.vectors(df).first()["features"]
    assert v.numNonzeros() == 30000


def test_regexes_survive_pathological_lengths(spark):
    huge_name = "x" * 50000
    rows = [("t", f"[1_{huge_name}]_wind_5:1 [2_y]_wind_6:1"),
            ("s", "[1_a]_wind_7:1" + " " * 50000)]
    df = spark.createDataFrame(rows, "device_id string, feature string")
    got = {r["device_id"]: r["indices"] for r in feat.parse(df, dim=10).collect()}
    assert got == {"t": [5, 6], "s": [7]}
    inst = spark.createDataFrame([("d", "111:1" + " " * 50000)], "device_id string, value string")
    keys = [r["key"] for r in feat.install_tokens(inst).collect()]
    assert keys == ["111"]


def test_chunks_give_the_rows_of_the_local_lookup(spark, monkeypatch):
    """Chunks smaller than a row's list, some items sent and the others joined by chunk."""
    rng = np.random.default_rng(6)
    rows = [(f"d{i % 50}", " ".join(f"{10 + k}:1" for k in rng.integers(0, 60, i % 9))) for i in range(200)]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709)).repartition(3)
    lookup_rows = [(f"1{k}", k, f"[1{k}_n]_wind_{k}:1") for k in range(40)]
    names = spark.createDataFrame(lookup_rows, "key string, idx bigint, token string")
    key = lambda df: sorted((r["device_id"], [tuple(i) for i in r["items"]]) for r in df.collect())
    expected = key(feat.row_items(feat.install_rows(installs, 20180709), names))
    for tokens, hot in ((1 << 20, 0), (5, 0), (7, 12), (1, 40)):
        monkeypatch.setattr(feat.C, "CHUNK_TOKENS", tokens)
        assert key(feat.chunk_items(feat.install_rows(installs, 20180709), names, hot)) == expected
    assert len(expected) == 200


def test_beyond_the_bound_a_frequent_key_is_joined_once_a_chunk(spark):
    """No token leaves its row: the keys of all rows are joined once for each chunk."""
    rows = [(f"d{i}", "111:1 112:1 111:1") for i in range(3000)]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709)).coalesce(1)
    names = feat.lookup_for(_ranked(spark), "11", None)
    df = feat.items_of(installs, 20180709, names, max_lookup_rows=0)
    path = re.search(r"file:\S*chunks-\w+", df.inputFiles()[0]).group(0)
    assert spark.read.parquet(path).selectExpr("sum(size(key))").first()[0] <= 2 * spark.read.parquet(path).count()
    assert feat.item_stats(df).first()["n_refined"] == 3000


def test_beyond_the_bound_most_items_are_sent_and_a_token_takes_few_bytes(spark, monkeypatch):
    """As many items are sent as the bounds of a lookup allow, and a chunk holds a
    row's items as small differences, each once."""
    monkeypatch.setattr(feat.C, "CHUNK_TOKENS", 1 << 14)
    names = spark.range(3000).selectExpr(
        "cast(id as string) key", "id idx", "concat('[', id, '_n]_wind_', id, ':1') token")
    assert feat._hot_items(names, 4000) >= 3000 and feat._hot_items(names, 2500) == 2500
    assert 0 < feat._hot_items(names, 4000, 100_000) < 3000
    rng = np.random.default_rng(8)
    rows = [(f"d{i}", " ".join(f"{k}:1" for k in rng.zipf(1.3, 300) % 3500)) for i in range(300)]
    installs = spark.createDataFrame(rows, "device_id string, value string").withColumn(
        "stat_date", F.lit(20180709)).coalesce(1)
    df = feat.chunk_items(feat.install_rows(installs, 20180709), names, 2500)
    path = re.search(r"file:\S*chunks-\w+", df.inputFiles()[0]).group(0)
    chunks = spark.read.parquet(path)
    n, packed = chunks.selectExpr("sum(aggregate(size, 0L, (a, x) -> a + x))", "sum(octet_length(codes))").first()
    tokens = feat.install_tokens(installs)
    assert n == tokens.distinct().count() < tokens.count() and packed < 2 * n
    key = lambda df: sorted((r["device_id"], [tuple(i) for i in r["items"]]) for r in df.collect())
    assert key(df) == key(feat.row_items(feat.install_rows(installs, 20180709), names))
