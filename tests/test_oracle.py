"""Every registered query with an oracle statement equals DuckDB on sf0.001;
the others run and return rows."""

import __spark_entry__ as E
from tools.oracle_compare import compare

SF = "/root/testdata/sf0.001"
HEAVY = {n for n in E.queries() if n.startswith("infer_") and n != "infer_gender"}
# the corpus operators have tests of their own
CORPUS = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}


def test_oracle_queries_match(spark):
    oracle = E.oracle_sql()
    oracle = {n: q for n, q in oracle.items() if n not in CORPUS}
    qs = {n: f for n, f in E.queries().items() if n in oracle}
    results = list(compare(spark, SF, qs, oracle))
    bad = [r for r in results if r[1] != "OK"]
    assert not bad, bad
    assert len(results) == len(oracle)


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_rows_only_queries_run(spark):
    oracle = E.oracle_sql()
    qs = {n: f for n, f in E.queries().items() if n not in oracle and n not in HEAVY | CORPUS}
    results = list(compare(spark, SF, qs, oracle))
    assert all(r[1] == "ROWS" for r in results), results


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["device_id", "attribute", "label", "is_predicted", "stat_date"]
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
