"""The registered queries: oracle equality, whole tables, the import guard."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
import corpus_pipeline
from tools.oracle_compare import compare

from traitlab.llm import queries

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(E.__file__))


def test_every_operator_is_registered():
    names = set(E.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_oracles_match(spark):
    results = list(compare(spark, SF, {n: queries.REGISTRY[n] for n in queries.ORACLE}, queries.ORACLE))
    assert results and all(r[1] == "OK" for r in results), results


def test_queries_cover_their_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_ngram_jaccard", "op2_sharding", "op4_license_scans", "op5_pii", "op8_lm_scoring",
                 "op9_quality_rules", "op10_token_ids"):
        df = queries.REGISTRY[name](spark, SF)
        assert df.select("doc_id").distinct().count() == df.count() == n, name
    assert queries.REGISTRY["op6_packing"](spark, SF).select("doc_id").distinct().count() == n
    assert queries.REGISTRY["op3_url_filters"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_entry_works_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(
        ".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); assert 'op1_ngram_jaccard' not in q; " \
           "assert set(o) <= set(q) and len(q) > 60"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True,
                   env={**os.environ, "PYTHONPATH": str(tmp_path / "repo")})
