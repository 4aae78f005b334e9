from pyspark.sql import functions as F

from traitlab.operators import labels as lbl

D = 20180709


def _q(spark, rows):
    cols = ["device_id", "q3", "q4", "q6", "q7", "q8", "q9", "q10", "q11"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_question_rules(spark):
    q = _q(spark, [
        ("d1", "A", "A", "A", "A", "A", "A", "A", "A"),
        ("d2", "E", "B", "B", "H", "B", "B", "C", "D"),
        ("d3", "F", "C", "L", "G", "C", "C", "", ""),
        ("d4", "H", "E", "Q", "AB", "", None, "AB", "B"),
        (None, "A", "A", "A", "A", "A", "A", "A", "A"),
    ])
    def labels(attr):
        return {r["device_id"]: r["label"] for r in lbl.question_label(q, attr).collect()}
    assert labels("education") == {"d1": 0.0, "d2": 1.0, "d3": 2.0}
    assert labels("marital") == {"d1": 0.0, "d2": 1.0}
    assert labels("career") == {"d1": 0.0, "d2": 1.0, "d4": 1.0}
    assert labels("parent") == {"d1": 1.0, "d2": 0.0}
    assert labels("car") == {"d1": 1.0, "d2": 0.0}
    assert labels("estate") == {"d1": 1.0, "d2": 0.0}
    assert labels("income") == {"d1": 0.0, "d2": 1.0, "d4": 1.0}
    assert labels("consumption") == {"d1": 0.0, "d2": 1.0, "d4": 1.0}


def test_dedup_keeps_smallest_label(spark):
    q = _q(spark, [("d1", "A", "B", "A", "A", "A", "A", "A", "A"),
                   ("d1", "A", "A", "A", "A", "A", "A", "A", "A")])
    assert lbl.question_label(q, "marital").collect()[0]["label"] == 0.0


def test_questionnaire_long_equals_single_labelers(spark, ctx001):
    q, c = ctx001.view("questionnaire"), ctx001.view("child_stage")
    long = lbl.questionnaire_long(q, c)
    for attr in list(lbl.QUESTION_RULES) + ["child"]:
        one = lbl.child_label(c) if attr == "child" else lbl.question_label(q, attr)
        a = sorted((r["device_id"], r["label"]) for r in one.collect())
        b = sorted((r["device_id"], r["label"]) for r in
                   long.where(F.col("attribute") == attr).collect())
        assert a == b, attr


def _accounts(spark):
    users = spark.createDataFrame(
        [(1, 2, "1990-01-01", D), (2, 1, "2005-05-05", D), (3, 0, "1930", D),
         (4, 1, "19", D), (5, 2, "", D), (6, 1, "abcd", D), (7, 2, "1960-01-01", D - 1)],
        "user_id bigint, sex int, birthdate string, stat_date int")
    devices = spark.createDataFrame(
        [(1, "a", D), (2, "a", D), (3, "b", D), (4, "c", D), (5, "d", D), (6, "e", D),
         (7, "f", D), (1, None, D)],
        "uid bigint, device_id string, stat_date int")
    return users, devices


def test_gender_shared_device_and_codes(spark):
    users, devices = _accounts(spark)
    got = {r["device_id"]: r["label"] for r in lbl.gender_label(users, devices, D).collect()}
    # device a has a male (2 -> 1) and a female (1 -> 0) user: smallest wins
    assert got == {"a": 0.0, "c": 0.0, "d": 1.0, "e": 0.0}


def test_age_bands_and_bad_dates(spark):
    users, devices = _accounts(spark)
    rows = lbl.age_label(users, devices, D, deduplicate=False).collect()
    got = sorted((r["device_id"], r["label"]) for r in rows)
    # 2018-1990 = 28 -> 2; 2018-2005 = 13 -> 0; 1930 -> 88 out of range; "19", "abcd" malformed
    assert got == [("a", 0.0), ("a", 2.0)]
    assert lbl.age_label(users, devices, D).count() == 1


def test_marital_from_age_by_position(spark):
    df = spark.createDataFrame([("a", "x", "35", D), ("b", "y", "36", D), ("c", "z", "n/a", D),
                                ("d", "w", "20", D - 1)],
                               "device_id string, src string, age string, stat_date int")
    got = {r["device_id"]: r["label"] for r in lbl.marital_from_age(df, D).collect()}
    assert got == {"a": 0.0, "b": 1.0}


def test_distribution_ratios_sum_to_one(spark, ctx001):
    d = lbl.distribution(lbl.gender_label(ctx001.view("users_info"), ctx001.view("device_rel"), D))
    rows = d.collect()
    assert abs(sum(r["ratio"] for r in rows) - 1.0) < 1e-12
    assert len({r["total"] for r in rows}) == 1


def test_hot_device_dedup(spark):
    # one device holds a third of all label rows
    rows = [("hot", float(i % 2)) for i in range(100)] + [(f"d{i}", 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "device_id string, label double").repartition(8)
    got = {r["device_id"]: r["label"] for r in lbl.dedup(df).collect()}
    assert len(got) == 201 and got["hot"] == 0.0


def test_via_view_round_trip(spark):
    from traitlab.sources.snapshot import via_view
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert via_view(df, "tl_view_test").collect() == df.collect()


def test_gender_codes_stored_as_text(spark):
    # D-1: a text sex column compares by value after an int cast
    users = spark.createDataFrame([(1, "2", D), (2, "1", D), (3, "x", D)],
                                  "user_id bigint, sex string, stat_date int")
    devices = spark.createDataFrame([(1, "a", D), (2, "b", D), (3, "c", D)],
                                    "uid bigint, device_id string, stat_date int")
    got = {r["device_id"]: r["label"] for r in lbl.gender_label(users, devices, D).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_matrix_takes_age_from_its_own_device_relation(spark, ctx001):
    from traitlab.plans import pipelines as pipe
    matrix = pipe.label_matrix(ctx001, list(pipe.ATTRIBUTES))
    for attr in ("gender", "age"):
        a = sorted((r["device_id"], r["label"]) for r in pipe.known_labels(ctx001, attr).collect())
        rows = matrix.where(F.col(f"label_{attr}").isNotNull()).collect()
        assert a == sorted((r["device_id"], r[f"label_{attr}"]) for r in rows), attr
    shared = lbl.age_label(ctx001.view("users_info"), ctx001.view("device_rel"), D)
    own = pipe.known_labels(ctx001, "age")
    assert sorted(map(tuple, shared.collect())) != sorted(map(tuple, own.collect()))
