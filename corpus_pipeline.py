"""The training-data pipeline over `documents`: five stages, each written as Parquet and read again.

Every stage works on all rows its predecessor kept. Rows are told apart by a number given when a stage's input
is written, so null or repeated doc_ids are safe. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.llm import bpe, decontaminate, near, secrets, weak_rules
from txwatch.llm.registry import table, vocabulary
from txwatch.session import materialise


def _numbered(docs: DataFrame) -> DataFrame:
    return materialise(docs.withColumn("_pipeline_row", F.monotonically_increasing_id()), "pipeline-rows")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose posterior quality is below one half."""
    return weak_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, 0.8): that with the smallest doc_id."""
    rows = _numbered(docs)
    found = near.near_duplicates(rows.select(F.col("_pipeline_row").alias("doc_id"), "text"))
    grouped = found.select(F.col("doc_id").alias("_pipeline_row"), "component_id").join(rows.select("_pipeline_row", "doc_id").hint("merge"), "_pipeline_row")
    keepers = grouped.groupBy("component_id").agg(F.min(F.struct("doc_id", "_pipeline_row")).alias("k")).select("k._pipeline_row")
    return rows.join(keepers.hint("merge"), "_pipeline_row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    rows = _numbered(docs)
    found = decontaminate.contamination(
        rows.select(F.col("_pipeline_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    hit = found.where(F.size("hits") > 0).select(F.col("doc_id").alias("_pipeline_row"))
    return rows.join(hit.hint("merge"), "_pipeline_row", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the values of live credentials; copied examples stay. n_chars follows the new text."""
    found = secrets.find_secrets(docs)
    text = secrets.masked(F.col("text"), F.col("spans"))
    changed = F.exists("spans", lambda s: s["live"])
    return (
        found.withColumn("n_chars", F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars")))
        .withColumn("text", text)
        .select(*docs.columns)
    )


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, n_tokens, digests of ids and decoded text, ids."""
    return bpe.encode_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokenise", tokenise),
]

#: Byte-pair encoding has no SQL counterpart; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
