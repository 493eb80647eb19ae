"""Queries of this package over the sample tables, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.llm import (
    archive, bpe, centroids, conversations, decontaminate, layout, near, rule_ensemble, secrets, simhash, slots,
    suffixes, weak_rules,
)
from txwatch.llm.oracle import SQL
from txwatch.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Where the public vocabularies lie; the folder is a package named public_tokenizers in some set-ups.
TOKENIZERS = os.environ.get("TXWATCH_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op4_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op6_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc-archive")
    archive.write_archive(pages, path)
    id_type = pages.schema["page_id"].dataType.simpleString()
    records = archive.read_archive(spark, path, id_type)
    return records.select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def op7_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op8_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.extract_text(table(spark, sf_dir, "pages"))


def op9_ownership_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), keep_text=False)
    spans = F.col("spans")
    counts = [secrets.n_of(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE]
    return found.select(
        "doc_id", *counts,
        F.sha2(secrets.listed(secrets.base_only(spans)).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"), secrets.frequencies(spans).alias("held_by"),
    )


def op10_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


def op11_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op12_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_rule_ensemble, op2_minhash_join, op3_suffix_dedup, op4_weak_rules, op5_virtual_slots, op6_content_archive,
        op7_prefix_join, op8_layout_text, op9_ownership_scan, op10_stream_bpe, op11_path_ranking, op12_covering_simhash,
        op13_bisector_clusters,
    )}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
