"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, filteraudit, fingerprint, jaccard, linededup, neardup, oracles, packing, quality, search, secrets, sharding, substring, warc
from ._spark import load, materialise, scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(load(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest_columns(substring.remove_repeats(load(spark, sf_dir, "documents")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warc(load(spark, sf_dir, "pages"), folder)
    return warc.resolve_revisits(materialise(warc.read_warc(spark, folder, with_payload=False).drop("payload"), "warc-records"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(load(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.fit(docs, load(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest_columns(decontaminate.find_contamination(docs, load(spark, sf_dir, "benchmark")))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(load(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan_secrets(load(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.lexical_search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}
ORACLE_SQL = {
    "op2_ngram_jaccard_join": oracles.OP2,
    "op3_substring_dedup": oracles.OP3,
    "op4_warc": oracles.OP4,
    "op5_sharding": oracles.OP5,
    "op7_line_dedup": oracles.OP7,
    "op8_benchmark_decontamination": oracles.OP8,
    "op12_lexical_search": oracles.OP12,
    "op13_filter_audit": oracles.OP13,
}
