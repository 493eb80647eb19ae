"""Aggregate facts of the gold layer and the monthly behaviour profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import off_hours
from txwatch.params import Params

PROFILE_COLUMNS = (
    "qtd_tx",
    "valor_total",
    "valor_medio",
    "valor_max",
    "valor_std",
    "hora_media",
    "destinos_unicos",
    "canais",
    "pct_madrugada",
)


def branch_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy("agencia_id", "dt").agg(
        F.count(F.lit(1)).alias("qtd_tx"),
        F.sum("valor").alias("valor_total"),
        F.avg("valor").alias("valor_medio"),
        F.count_if(F.col("flag_fora_horario")).alias("qtd_fora_horario"),
        F.count_if(F.col("flag_valor_alto")).alias("qtd_valor_alto"),
    )


def operator_day(silver: DataFrame) -> DataFrame:
    attended = silver.where(F.col("operador_id").isNotNull())
    return attended.groupBy("operador_id", "agencia_id", "dt").agg(
        F.count(F.lit(1)).alias("qtd_tx"),
        F.sum("valor").alias("valor_total"),
        F.count_if(F.col("flag_fora_horario")).alias("qtd_fora_horario"),
    )


def _few(column: str) -> Column:
    """Distinct values of a column with a handful of them. A second count_distinct beside the payees'
    would copy every row once per distinct column before the shuffle."""
    return F.size(F.collect_set(column)).cast("long")


def member_month(silver: DataFrame) -> DataFrame:
    monthly = silver.withColumn("ano_mes", F.date_format("dt", "yyyy-MM"))
    return monthly.groupBy("associado_id", "ano_mes").agg(
        F.count(F.lit(1)).alias("qtd_tx"),
        F.sum("valor").alias("valor_total"),
        F.avg("valor").alias("ticket_medio"),
        F.count_distinct("conta_destino").alias("destinos_unicos"),
        _few("canal").alias("canais_distintos"),
    )


def member_profile(silver: DataFrame, params: Params) -> DataFrame:
    """Monthly behaviour vector per member; undefined statistics count as 0."""
    hour = F.hour("dt_transacao")
    monthly = silver.where(F.col("associado_id").isNotNull()).withColumn(
        "ano_mes", F.date_format("dt_transacao", "yyyy-MM")
    )
    profile = monthly.groupBy("associado_id", "ano_mes").agg(
        F.count(F.lit(1)).alias("qtd_tx"),
        F.sum("valor").alias("valor_total"),
        F.avg("valor").alias("valor_medio"),
        F.max("valor").alias("valor_max"),
        F.stddev_samp("valor").alias("valor_std"),
        F.avg(hour).alias("hora_media"),
        F.count_distinct("conta_destino").alias("destinos_unicos"),
        _few("canal").alias("canais"),
        F.avg(off_hours(hour, params).cast("double")).alias("pct_madrugada"),
    )
    return profile.fillna(0)
