"""Registered queries of the corpus operators.

Each callable takes (spark, sf_dir), applies its operator with production
parameters to the whole intended table, and returns the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from . import (decontamination, fim, fingerprints, jaccard, licenses, lm, merkle, oracle, packing, pii, quality,
               reputation, sharding, token_table)
from .common import scratch_file, table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"))
    return sharding.shuffle(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = reputation.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"),
                                    reputation.page_outcome(F.col("html")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        "base_labels", "labels", "score", F.coalesce(F.size("detections"), F.lit(0)).alias("n_detections"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.regexp_count("base_spans", F.lit(kind + ":")).cast("long").alias("n_" + kind)
              for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "context", "step_id")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_file(spark, "tokens")
    token_table.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_table.read_tokens(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).select("doc_id", "item_id", "score", "first_word")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"),
                           keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "host_strict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    # rows whose text the tampering changes; the others fold their own leaf
    changed = F.when(even & F.contains("text", F.lit("\n")),
                     merkle.digest(*fields, F.translate("text", "\n", "")))
    proved = merkle.manifest(docs.withColumn("_changed", changed), merkle.digest(*fields, F.col("text")),
                             "source", "doc_id", ["doc_id", "_changed"])
    folded = proved.withColumn("folded_root", merkle.fold(F.coalesce("_changed", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = fingerprints.with_fingerprint(docs, "text", "fingerprint")
    docs = fingerprints.with_next(docs, "doc_id", "text", ["text", "fingerprint"])
    docs = docs.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
    docs = fingerprints.with_fingerprint(docs, "edited", "edited_fingerprint")
    near = lambda other: fingerprints.likeness(F.col("fingerprint"), F.col(other))
    return docs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"),
        near("next_fingerprint").alias("near_next"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sharding": op2_sharding,
    "op3_url_filters": op3_url_filters,
    "op4_license_scans": op4_license_scans,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_ids": op10_token_ids,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_fingerprints": op12_fingerprints,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = oracle.STATEMENTS
