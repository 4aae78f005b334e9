"""Corpus preparation pipeline over the documents table.

``STAGES`` are applied in order; each stage's rows are written as Parquet and
reread as the next one's documents. Every stage reads all rows of its
predecessor; all but the last return the columns of their input:

* quality_rules drops documents that fail the base rules or their host's verdict;
* ngram_jaccard keeps the least id of every group of near copies;
* decontamination drops documents that overlap a benchmark item;
* pii replaces personal data in the text by the kind of data;
* packing returns the pieces of packed sequences.

Nulls in any column, empty texts, repeated rows, empty tables and further
columns pass through; the operators' docstrings define each result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from traitlab.llm import decontamination, jaccard, packing, pii, quality
from traitlab.llm.common import release_scratch, scratch_file, scratch_paths

# No SQL: near copies, trained span selection and packing are not expressible.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


# Scratch tables that the stage before has left.
_LEFT: set[str] = set()


def _fresh(stage):
    """A stage begins when its predecessor's rows are written, so what that
    one left in the shared folder is deleted first."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, _LEFT)
        before = scratch_paths()
        out = stage(spark, docs, sf_dir)
        _LEFT.clear()
        _LEFT.update(scratch_paths() - before)
        return out

    return run


STAGES = [
    ("quality_rules", _fresh(quality_rules)),
    ("ngram_jaccard", _fresh(ngram_jaccard)),
    ("decontamination", _fresh(decontaminate)),
    ("pii", _fresh(redact)),
    ("packing", _fresh(pack)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_file(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
