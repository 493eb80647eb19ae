"""From an alert to the transactions behind it, whatever it is about: a transaction, a member, a branch, a month.

An alert row names its entity by text alone. Evidence is typed: (entidade, tipo_entidade, regra_id, alerta, de,
ate), one row per finding, with the span of time that the finding judged. Spans are cut into days, so alerts meet
transactions by (key, day): an equi-join in which no key brings its whole history.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import sorted_distinct
from txwatch.params import Params

#: Kind of entity by the key column that a detector's findings have; the first one found counts.
KINDS = {"transacao_id": "TRANSACAO", "associado_id": "ASSOCIADO", "agencia_id": "AGENCIA"}
_SCHEMA = "entidade string, tipo_entidade string, regra_id string, alerta boolean, de timestamp_ntz, ate timestamp_ntz"


def _span(found: DataFrame, params: Params) -> tuple[Column, Column]:
    """First instant judged, and the first one after."""
    has = set(found.columns)
    if "ano_mes" in has:
        start = F.to_date(F.concat("ano_mes", F.lit("-01")))
        return start.cast("timestamp_ntz"), F.add_months(start, 1).cast("timestamp_ntz")
    if "dt" not in has:
        return F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")
    day = F.col("dt").cast("date").cast("timestamp_ntz")
    if "hora" in has:
        return day + F.make_dt_interval(hours=F.col("hora")), day + F.make_dt_interval(hours=F.col("hora") + 1)
    # A structuring finding of a day rests on windows that reach into the day before.
    back = F.when(F.col("regra_id") == "D5_FRACIONAMENTO", F.lit(params.structuring_hours)).otherwise(F.lit(0))
    return day - F.make_dt_interval(hours=back), day + F.expr("interval 1 day")


def evidence(findings: list[DataFrame], params: Params) -> DataFrame:
    """The findings about one entity each. Those about everything (entity '-') have no transactions of their own."""
    parts = []
    for found in findings:
        key = next((k for k in KINDS if k in found.columns), None)
        if key is None:
            continue
        first, past = _span(found, params)
        parts.append(
            found.where(F.col(key).isNotNull()).select(
                F.col(key).cast("string").alias("entidade"), F.lit(KINDS[key]).alias("tipo_entidade"), "regra_id",
                F.coalesce("alerta", F.lit(False)).alias("alerta"), first.alias("de"), past.alias("ate"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _judged_by(rule: Column, params: Params) -> Column:
    """Whether the rule looks at a transaction at all."""
    small = F.col("tipo").isin(*params.structuring_types) & (F.col("valor") < params.structuring_limit)
    looks = F.when(rule == "D2_EWMA", F.col("tipo").startswith("PIX")).when(rule == "D5_FRACIONAMENTO", small)
    return F.coalesce(looks.otherwise(F.lit(True)), F.lit(False))


def alert_transactions(alerts: DataFrame, found: DataFrame, tx: DataFrame, params: Params) -> DataFrame:
    """One row per alert and transaction behind it, with the rules that point there.

    `alerts` has alerta_id and the entity in transacao_id; `found` is `evidence`. An alert rests on its findings
    that alert, or on all of them where none does. Repeated findings and alerts count once.
    """
    named = alerts.select("alerta_id", F.col("transacao_id").alias("entidade")).where("entidade is not null").distinct()
    loud = found.where("alerta").select("entidade", F.lit(True).alias("_loud")).distinct()
    rests = named.join(found, "entidade").join(loud, "entidade", "left").where("alerta or _loud is null")
    shown = ["transacao_id", "associado_id", "agencia_id", "dt_transacao", "tipo", "valor", "canal"]
    rows = tx.select(*shown, F.to_date("dt_transacao").alias("_dia"))

    days = F.explode(F.sequence(F.to_date("de"), F.to_date(F.col("ate") - F.expr("interval 1 microsecond"))))
    spans = rests.where("de is not null").select("alerta_id", "entidade", "tipo_entidade", days.alias("_dia"), "regra_id", "de", "ate")
    # A day holds at most its hours and a few days and months that cover it.
    spans = spans.groupBy("alerta_id", "entidade", "tipo_entidade", "_dia").agg(
        F.collect_set(F.struct("regra_id", "de", "ate")).alias("_spans")
    )
    when = F.col("dt_transacao")
    hits = F.filter("_spans", lambda s: (s["de"] <= when) & (when < s["ate"]) & _judged_by(s["regra_id"], params))
    parts = []
    for key, kind in KINDS.items():
        if key == "transacao_id":
            own = rests.where(F.col("tipo_entidade") == kind).groupBy("alerta_id", "tipo_entidade", "entidade")
            own = own.agg(sorted_distinct(F.col("regra_id"), "|").alias("regras"))
            joined = rows.join(own, F.col(key) == F.col("entidade"))
        else:
            own = spans.where(F.col("tipo_entidade") == kind).withColumnRenamed("entidade", "_key")
            joined = rows.join(own, (F.col(key) == F.col("_key")) & (rows["_dia"] == own["_dia"]))
            joined = joined.withColumn("_hits", hits).where(F.size("_hits") > 0)
            joined = joined.withColumn("regras", F.array_join(F.array_sort(F.array_distinct("_hits.regra_id")), "|"))
        parts.append(joined.select("alerta_id", "tipo_entidade", *shown, "regras"))
    return reduce(DataFrame.unionByName, parts)
