"""The audit cockpit's measures, lists and charts as queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.session import materialise


def kpi_summary(alerts: DataFrame, as_of: str) -> DataFrame:
    """Open and critical alerts, mean score, share of false positives, mean days in treatment."""
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("dt_alerta"))
    status = F.col("status")
    return alerts.agg(
        F.count_if(status == "ABERTO").alias("alertas_abertos"),
        F.count_if(F.col("severidade") == "CRITICA").alias("alertas_criticos"),
        F.avg("score").alias("score_medio"),
        F.try_divide(
            F.count_if(status == "FALSO_POSITIVO"), F.count_if(status.isNotNull() & (status != ""))
        ).alias("pct_falso_positivo"),
        F.avg(F.when(status != "ABERTO", days)).alias("dias_tratamento"),
    )


def alerts_by_family_month(alerts: DataFrame) -> DataFrame:
    month = F.date_format("dt_alerta", "yyyy-MM").alias("ano_mes")
    return alerts.groupBy("familia", month).agg(F.count(F.lit(1)).alias("qtd"))


def _with_transaction(alerts: DataFrame, tx: DataFrame, *columns: Column) -> DataFrame:
    """Alerts next to columns of their transaction.

    The fact is first cut down by an inner join with the alerts' ids. There the few alerts can be the
    build side, so Catalyst broadcasts them by their size and does not exchange the fact; a left join
    from the alerts could not.
    """
    ids = alerts.select("transacao_id").where(F.col("transacao_id").isNotNull()).distinct()
    hit = tx.select("transacao_id", *columns).join(ids, "transacao_id")
    return alerts.join(hit, "transacao_id", "left")


def alert_branch(alerts: DataFrame, tx: DataFrame, branches: DataFrame) -> DataFrame:
    """Alerts with the branch of their transaction; an alert on a whole branch, one of the agencia_id of
    `branches`, has that. Alerts on members or on everything have none."""
    known = _with_transaction(alerts, tx, F.col("agencia_id").alias("_agencia"))
    own = branches.select(F.col("agencia_id").alias("_own")).where(F.col("_own").isNotNull()).distinct()
    known = known.join(own, F.col("transacao_id") == F.col("_own"), "left")
    return known.withColumn("agencia_id", F.coalesce("_agencia", "_own")).drop("_agencia", "_own")


def top_branches(alerts: DataFrame, tx: DataFrame, branch_day: DataFrame, k: int = 10) -> DataFrame:
    """The k branches with most open alerts per thousand transactions, and one row without a branch for
    the open alerts that belong to none, if there are any."""
    opened = alert_branch(alerts.where(F.col("status") == "ABERTO"), tx, branch_day)
    opened = opened.groupBy("agencia_id").agg(F.count(F.lit(1)).alias("alertas_abertos"))
    volume = branch_day.groupBy("agencia_id").agg(F.sum("qtd_tx").alias("qtd_tx"))
    ratio = F.try_divide(F.col("alertas_abertos"), F.col("qtd_tx") / 1000)
    rated = volume.join(opened, "agencia_id").withColumn("alertas_por_mil", ratio)
    best = rated.orderBy(F.desc("alertas_por_mil"), "agencia_id").limit(k)
    nowhere = opened.where(F.col("agencia_id").isNull())
    return best.unionByName(nowhere, allowMissingColumns=True)


def alerts_by_city(alerts: DataFrame, tx: DataFrame, branches: DataFrame) -> DataFrame:
    """Alerts per city and family; those without a branch are counted under no city."""
    placed = alert_branch(alerts, tx, branches).join(branches, "agencia_id", "left")
    return placed.groupBy("municipio", "familia").agg(F.count(F.lit(1)).alias("qtd"))


def alert_drillthrough(
    alerts: DataFrame, silver: DataFrame, condition: Column | None = None
) -> DataFrame:
    """Open alerts that meet `condition`, next to the transaction each one points to."""
    opened = alerts.where(F.col("status") == "ABERTO")
    names = ("agencia_id", "municipio", "valor", "canal", "geo_lat", "geo_lon")
    listed = _with_transaction(opened, silver, *map(F.col, names))
    if condition is not None:
        listed = listed.where(condition)
    return listed.select(
        "alerta_id",
        "transacao_id",
        "dt_alerta",
        "familia",
        "severidade",
        "score",
        "motivo",
        "agencia_id",
        "municipio",
        "valor",
        "canal",
        "geo_lat",
        "geo_lon",
    )


def star_branch_day(fact: DataFrame, branches: DataFrame, days: DataFrame) -> DataFrame:
    """Branch-day fact rolled up over its dimensions."""
    star = fact.join(branches, "agencia_id", "left").join(F.broadcast(days.dropDuplicates(["dt"])), "dt", "left")
    return star.groupBy("municipio", "ano", "mes", "dia_util").agg(
        F.sum("qtd_tx").alias("qtd_tx"),
        F.sum("valor_total").alias("valor_total"),
        F.sum("qtd_valor_alto").alias("qtd_valor_alto"),
    )


def star_operator_day(fact: DataFrame, operators: DataFrame, days: DataFrame) -> DataFrame:
    """Operator-day fact rolled up by role, working day and whether the branch is the operator's own."""
    star = fact.join(operators, "operador_id", "left").join(F.broadcast(days.dropDuplicates(["dt"])), "dt", "left")
    home = (F.col("agencia_id") == F.col("agencia_lotacao")).alias("na_lotacao")
    return star.groupBy("funcao", "dia_util", home).agg(
        F.sum("qtd_tx").alias("qtd_tx"),
        F.sum("valor_total").alias("valor_total"),
        F.sum("qtd_fora_horario").alias("qtd_fora_horario"),
    )


def score_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins of score over 0..1, each with the 99th percentile of all scores. The one column is stored
    first, as bins and percentile read it several times."""
    scores = materialise(scores.select("score"), "scores")
    slot = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1))
    counts = scores.where(F.col("score").isNotNull()).groupBy(slot.alias("faixa"))
    counts = counts.agg(F.count(F.lit(1)).alias("qtd"))
    top = exact_quantiles(scores, "score", [0.99]).select(F.col("quantil").alias("p99"))
    return counts.crossJoin(F.broadcast(top))


def confusion_matrix(alerts: DataFrame, cut: float = 0.85) -> DataFrame:
    return alerts.groupBy("status", (F.col("score") >= cut).alias("acima")).agg(
        F.count(F.lit(1)).alias("qtd")
    )


def fp_rate_by_rule(alerts: DataFrame) -> DataFrame:
    """False positives over judged alerts, for every rule an alert names."""
    judged = alerts.where(F.col("status").isin("CONFIRMADO", "FALSO_POSITIVO"))
    per_rule = judged.select(F.explode(F.split("regra_id", "[|]")).alias("regra"), "status")
    false = F.count_if(F.col("status") == "FALSO_POSITIVO")
    return per_rule.groupBy("regra").agg(
        F.count(F.lit(1)).alias("julgados"),
        false.alias("falsos"),
        F.try_divide(false, F.count(F.lit(1))).alias("taxa_fp"),
    )
