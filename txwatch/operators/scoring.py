"""Weighted combination of detector findings and the alert table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.functions.columns import clip01, severity, sorted_distinct
from txwatch.params import DEFAULT_WEIGHTS, Params
from txwatch.sources.schemas import FINDING_COLUMNS, FINDINGS

_ENTITY_KEYS = ("transacao_id", "associado_id", "agencia_id")


def as_findings(detected: DataFrame) -> DataFrame:
    """The shared finding row; its entity is the first key column the detector has, else '-'."""
    key = next((k for k in _ENTITY_KEYS if k in detected.columns), None)
    entity = F.col(key).cast("string") if key else F.lit("-")
    return detected.select(entity.alias("entidade"), *FINDING_COLUMNS)


def union_findings(spark: SparkSession, detected: list[DataFrame | None]) -> DataFrame:
    parts = [as_findings(d) for d in detected if d is not None]
    if not parts:
        return spark.createDataFrame([], FINDINGS)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _weight(weights: dict[str, float]) -> Column:
    chain = F.lit(0.0)
    for rule, weight in weights.items():
        chain = F.when(F.col("regra_id") == rule, F.lit(float(weight))).otherwise(chain)
    return chain


def combine_scores(
    spark: SparkSession, detected: list[DataFrame | None], params: Params
) -> DataFrame:
    """One row per entity at or above the lowest severity band.

    The score is the weighted mean over all findings of the entity, alerting or not. Sums and sets of
    distinct texts combine before the shuffle, so an entity with very many findings leaves each map
    task as one row.
    """
    weights = params.weights or DEFAULT_WEIGHTS
    # NaN and null scores count as 0 and keep their weight.
    score = F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))
    weighed = union_findings(spark, detected).where(F.col("entidade").isNotNull())
    weighed = weighed.withColumn("_w", _weight(weights)).withColumn("_s", score * F.col("_w"))
    per_entity = weighed.groupBy("entidade").agg(
        F.sum("_s").alias("_s"),
        F.sum("_w").alias("peso_total"),
        sorted_distinct(F.col("familia"), "|").alias("familias"),
        sorted_distinct(F.col("regra_id"), "|").alias("regras"),
        sorted_distinct(F.col("motivo"), " | ").alias("motivos"),
        F.min("familia").alias("familia"),
    )
    mean = F.when(F.col("peso_total") != 0, F.col("_s") / F.col("peso_total")).otherwise(0.0)
    return (
        per_entity.withColumn("score", clip01(mean))
        .withColumn("severidade", severity(F.col("score"), params))
        .where(F.col("severidade").isNotNull())
        .select(
            "entidade", "score", "peso_total", "familias", "regras", "motivos", "severidade", "familia"
        )
    )


def build_alerts(combined: DataFrame, run_at: str) -> DataFrame:
    """The nine-column alert table. Ids derive from entity and rules, so a rerun repeats them."""
    identity = F.sha2(F.concat_ws("|", "entidade", "regras"), 256)
    return combined.select(
        identity.alias("alerta_id"),
        F.col("entidade").alias("transacao_id"),
        F.lit(run_at).cast("timestamp_ntz").alias("dt_alerta"),
        F.col("regras").alias("regra_id"),
        "familia",
        "severidade",
        "score",
        F.col("motivos").alias("motivo"),
        F.lit("ABERTO").alias("status"),
    )


def severity_distribution(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severidade").agg(F.count(F.lit(1)).alias("qtd"))
