"""Cleaning, derived columns, dimension joins and audit flags of the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from txwatch.functions.columns import first_digit, no_nan, off_hours
from txwatch.params import HOLIDAYS, Params

_ORDER_FIRST = "dt_ingestao"


def clean(raw: DataFrame) -> DataFrame:
    """Usable rows, one per transacao_id: the first one ingested, ties by a hash of the rest.

    The row_number() = 1 filter becomes a group limit that already runs before the shuffle, so any
    number of copies of one id shrinks to one row per map task.
    """
    usable = no_nan(raw).where(
        F.col("transacao_id").isNotNull() & (F.col("valor") > 0) & F.col("dt_transacao").isNotNull()
    )
    others = [c for c in raw.columns if c not in ("transacao_id", _ORDER_FIRST)]
    order = [F.col(_ORDER_FIRST).asc_nulls_last()] if _ORDER_FIRST in raw.columns else []
    copies = Window.partitionBy("transacao_id").orderBy(*order, F.xxhash64(*others))
    numbered = usable.withColumn("_copy", F.row_number().over(copies))
    return numbered.where("_copy = 1").drop("_copy")


# Fixed order: the first reason that applies is a row's reason.
REASONS = ("SEM_ID", "SEM_DATA", "VALOR_AUSENTE", "VALOR_NAO_POSITIVO", "DUPLICADA")


class TooManyRejects(ValueError):
    """More rows were rejected than a run may lose."""


def judged(raw: DataFrame) -> DataFrame:
    """All rows of `raw`, NaN as null, with `motivo_rejeicao`: null for those that `clean` keeps, else a reason.

    The survivor of several copies is the one that `clean` chooses. Rows without an id are no copies of each other,
    and unusable rows never compete with usable ones.
    """
    tidy = no_nan(raw)
    reason = (
        F.when(F.col("transacao_id").isNull(), REASONS[0]).when(F.col("dt_transacao").isNull(), REASONS[1])
        .when(F.col("valor").isNull(), REASONS[2]).when(F.col("valor") <= 0, REASONS[3])
    )
    marked = tidy.withColumn("_reason", reason)
    others = [c for c in raw.columns if c not in ("transacao_id", _ORDER_FIRST)]
    order = [F.col(_ORDER_FIRST).asc_nulls_last()] if _ORDER_FIRST in raw.columns else []
    copies = Window.partitionBy("transacao_id").orderBy(*order, F.xxhash64(*others))
    usable = marked.where("_reason is null").withColumn("_copy", F.row_number().over(copies))
    usable = usable.withColumn("_reason", F.when(F.col("_copy") > 1, REASONS[4])).drop("_copy")
    # Unusable rows need no company: they skip the exchange, where many of one id would be a hot group.
    return usable.unionByName(marked.where("_reason is not null")).withColumnRenamed("_reason", "motivo_rejeicao")


def split_rejects(raw: DataFrame, path: str, max_share: float | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Clean and rejected rows from one pass, written below `path` in one folder per reason, and their counts.

    Counts are observed while the rows are written. A run that rejects more than `max_share` of its rows stops with
    TooManyRejects; what it wrote stays for inspection. The kept rows are those of `clean`.
    """
    seen = Observation("rejects")
    kind = F.coalesce("motivo_rejeicao", F.lit("OK"))
    rows = judged(raw)
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("linhas"), *[F.count_if(F.col("motivo_rejeicao") == r).alias(r) for r in REASONS]
    )
    counted.withColumn("situacao", kind).drop("motivo_rejeicao").write.mode("overwrite").partitionBy("situacao").parquet(path)
    counts = {name: int(seen.get.get(name) or 0) for name in ("linhas", *REASONS)}
    lost = sum(counts[r] for r in REASONS)
    if max_share is not None and lost > max_share * counts["linhas"]:
        raise TooManyRejects(f"{lost} of {counts['linhas']} rows rejected: {counts}")
    stored = raw.sparkSession.read.schema(rows.drop("motivo_rejeicao").schema.add("situacao", "string")).parquet(path)
    rejected = stored.where("situacao <> 'OK'").withColumnRenamed("situacao", "motivo_rejeicao")
    return stored.where("situacao = 'OK'").drop("situacao"), rejected, counts


def derive(tx: DataFrame) -> DataFrame:
    """dt, hora, dia_semana (0 = Monday) and primeiro_digito."""
    return tx.withColumns(
        {
            "dt": F.to_date("dt_transacao"),
            "hora": F.hour("dt_transacao"),
            "dia_semana": F.weekday("dt_transacao"),
            "primeiro_digito": first_digit(F.col("valor")),
        }
    )


def calendar(days: DataFrame) -> DataFrame:
    """One row per day between the smallest and largest `dt` of `days`."""
    span = days.agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    every = span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("dt")
    )
    fixed = [month * 100 + day for month, day in HOLIDAYS]
    every = every.select(
        "dt",
        F.year("dt").alias("ano"),
        F.month("dt").alias("mes"),
        F.weekday("dt").alias("dia_semana"),
        (F.month("dt") * 100 + F.dayofmonth("dt")).isin(fixed).alias("feriado"),
    )
    business = (F.col("dia_semana") < 5) & ~F.col("feriado")
    return every.select("dt", "ano", "mes", "dia_semana", business.alias("dia_util"), "feriado")


def join_dimensions(
    tx: DataFrame, members: DataFrame, branches: DataFrame, days: DataFrame
) -> DataFrame:
    """Left joins to the three dimensions.

    Members and branches carry no hint: Catalyst broadcasts them below its size threshold and
    otherwise shuffles, with adaptive skew splitting. The calendar holds at most one row per day of
    the date domain, so it is always broadcast; its own dia_semana would collide and is left out.
    """
    one_per_day = days.drop("dia_semana").dropDuplicates(["dt"])
    return (
        tx.join(no_nan(members), "associado_id", "left")
        .join(no_nan(branches), "agencia_id", "left")
        .join(F.broadcast(one_per_day), "dt", "left")
    )


def flag(tx: DataFrame, params: Params) -> DataFrame:
    """The four deterministic audit flags."""
    high_authority = (F.col("valor") > params.authority_value) & (F.col("canal") != "AGENCIA")
    return tx.withColumns(
        {
            "flag_fora_horario": off_hours(F.col("hora"), params),
            "flag_fim_de_semana": ~F.coalesce(F.col("dia_util"), F.lit(True)),
            "flag_valor_alto": F.col("valor") > params.high_value,
            "flag_alta_alcada": high_authority,
        }
    )


def enrich(
    tx: DataFrame, members: DataFrame, branches: DataFrame, days: DataFrame, params: Params
) -> DataFrame:
    return flag(join_dimensions(derive(tx), members, branches, days), params)
