"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs.  All but the last return the columns of ``documents``; ``n_chars``
follows the text where a stage cuts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, jaccard, linededup, packing, quality
from scorelake.llm._spark import drop_scratch, load, materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_QUALITY = 0.5


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, load(spark, sf_dir, "labels"))
    return quality.score(docs, model, COLUMNS).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and with them documents that were nothing else."""
    found = linededup.dedup_lines(docs.select(*COLUMNS))
    return _with_length(found.where("n_removed = 0 or n_removed < n_lines"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles (Jaccard 0.8 or more), the first stays.

    A document is a row's id and text together: rows that share an id but not a text are judged apart,
    and of rows equal in both one stays.  The first has the smallest id, then the smallest hash.
    """
    # Numbers that follow (id, hash), so that the smallest of a component is its first document.
    distinct = docs.select(*COLUMNS).withColumn("_digest", F.xxhash64("text")).dropDuplicates(["doc_id", "_digest"])
    ordered = distinct.repartitionByRange("doc_id", "_digest").sortWithinPartitions("doc_id", "_digest").withColumn("_row", F.monotonically_increasing_id())
    numbered = materialise(ordered, "pipeline-numbered")
    found = jaccard.jaccard_components(numbered.select(F.col("_row").alias("doc_id"), "text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_row"))
    return numbered.join(kept, "_row", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents without another word go."""
    found = decontaminate.find_contamination(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"), remove=True)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return _with_length(found.where((n_hit == 0) | (n_hit < F.col("n_words"))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the classifier; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        kept = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:  # what the stage read is in no plan any more
            drop_scratch(spark, docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
