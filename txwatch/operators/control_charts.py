"""Control charts: CUSUM, EWMA and hourly limits.

The recursions are written as running windows over one row per key and period, so a group is bounded
by the calendar. Raw rows are first combined by groupBy, which tolerates hot keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.functions.columns import clip01, positive_or_one
from txwatch.params import Params


def cusum_series(df: DataFrame, key: str, at: str, value: str, params: Params) -> DataFrame:
    """Two-sided tabular CUSUM per key: mu0, sigma, s_h, s_l and the alert.

    A running sum clipped at zero equals the plain running sum less its lowest point so far (or zero,
    if it never went below).
    """
    whole = Window.partitionBy(key)
    past = whole.orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    step = F.col(value) - F.col("mu0")
    slack = F.lit(params.cusum_slack) * F.col("sigma")
    zero = F.lit(0.0)
    limit = F.lit(params.cusum_limit) * F.col("sigma")
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("mu0", F.avg(value).over(whole))
        .withColumn("sigma", positive_or_one(F.stddev_samp(value).over(whole)))
        .withColumn("_up", F.sum(step - slack).over(past))
        .withColumn("_down", F.sum(step + slack).over(past))
        .withColumn("s_h", F.col("_up") - F.least(zero, F.min("_up").over(past)))
        .withColumn("s_l", F.col("_down") - F.greatest(zero, F.max("_down").over(past)))
        .withColumn("alerta", (F.col("s_h") > limit) | (F.col("s_l") < -limit))
        .select(key, at, value, "mu0", "sigma", "s_h", "s_l", "alerta")
    )


def cusum(df: DataFrame, key: str, at: str, value: str, params: Params) -> DataFrame:
    """Rule D1: one finding per key and period."""
    series = cusum_series(df, key, at, value, params)
    reach = F.greatest(F.col("sigma") * params.cusum_limit, F.lit(1.0))
    text = F.concat(F.lit("CUSUM fora dos limites em "), F.col(key))
    return series.select(
        key,
        at,
        F.lit("D1_CUSUM").alias("regra_id"),
        F.lit("FRAUDE").alias("familia"),
        "alerta",
        clip01(F.abs(F.col("s_h") - F.col("s_l")) / reach).alias("score"),
        F.when(F.col("alerta"), text).alias("motivo"),
    )


def branch_volume(tx: DataFrame) -> DataFrame:
    """Transactions per branch and day."""
    known = tx.where(F.col("agencia_id").isNotNull())
    return known.groupBy("agencia_id", "dt").agg(F.count(F.lit(1)).alias("qtd_tx"))


def cusum_by_branch(tx: DataFrame, params: Params) -> DataFrame:
    return cusum(branch_volume(tx), "agencia_id", "dt", "qtd_tx", params)


def volume_findings(tx: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """Rules D1 and D3 off one pass: daily volumes are added up from the hourly ones."""
    hourly = hourly_volume(tx)
    daily = hourly.groupBy("agencia_id", "dt").agg(F.sum("qtd").alias("qtd_tx"))
    return cusum(daily, "agencia_id", "dt", "qtd_tx", params), limits(hourly, params)


def ewma_series(df: DataFrame, key: str, at: str, value: str, params: Params) -> DataFrame:
    """EWMA per key with its exact variance: i, z, superior, inferior, alerta.

    Unrolled, z after p points is keep^p * (start + weight * sum of x_j / keep^j). The powers are
    taken inside blocks short enough to stay within double range; what a block inherits is the end of
    the block before, as anything older is scaled below 1e-90.
    """
    weight = float(params.ewma_weight)
    keep = 1.0 - weight
    block = max(1, int(210.0 / -math.log(keep))) if 0.0 < keep < 1.0 else 1

    whole = Window.partitionBy(key)
    ordered = whole.orderBy(at)
    past = ordered.rowsBetween(Window.unboundedPreceding, 0)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(key, "_block").orderBy(at)
    in_block = in_block.rowsBetween(Window.unboundedPreceding, 0)

    points = (
        df.where(F.col(key).isNotNull())
        .withColumn("_n", F.count(F.lit(1)).over(whole))
        .where(F.col("_n") >= params.ewma_min_points)
        .withColumn("mu0", F.avg(value).over(whole))
        .withColumn("sigma", positive_or_one(F.stddev_samp(value).over(whole)))
        .withColumn("i", F.row_number().over(ordered))
    )
    if keep > 0.0:
        power = F.pow(F.lit(keep), F.col("_p").cast("double"))
        points = (
            points.withColumn("_block", F.floor((F.col("i") - 1) / block))
            .withColumn("_p", (F.col("i") - 1) % block + 1)
            .withColumn("_own", power * weight * F.sum(F.col(value) / power).over(in_block))
            .withColumn("_end", F.when(F.col("_p") == block, F.col("_own")))
            .withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier))
            .withColumn("z", F.col("_own") + power * F.coalesce("_carry", "mu0"))
        )
    else:
        points = points.withColumn("z", F.col(value).cast("double"))
    growth = F.lit(1.0) - F.pow(F.lit(keep), 2.0 * F.col("i"))
    width = F.lit(params.ewma_width) * F.col("sigma") * F.sqrt(weight / (2.0 - weight) * growth)
    return (
        points.withColumn("superior", F.col("mu0") + width)
        .withColumn("inferior", F.col("mu0") - width)
        .withColumn("alerta", (F.col("z") > F.col("superior")) | (F.col("z") < F.col("inferior")))
        .select(key, at, value, "i", "z", "superior", "inferior", "alerta")
    )


def ewma(df: DataFrame, key: str, at: str, value: str, params: Params) -> DataFrame:
    """Rule D2: one finding per key and period of keys with enough periods."""
    series = ewma_series(df, key, at, value, params)
    middle = (F.col("superior") + F.col("inferior")) / 2
    half = F.greatest(F.col("superior") - F.col("inferior"), F.lit(1e-9)) / 2
    return series.select(
        key,
        at,
        F.lit("D2_EWMA").alias("regra_id"),
        F.lit("FRAUDE").alias("familia"),
        "alerta",
        clip01(F.abs(F.col("z") - middle) / half).alias("score"),
        F.when(F.col("alerta"), F.lit("EWMA do ticket médio fora de controle")).alias("motivo"),
    )


def pix_ticket(tx: DataFrame) -> DataFrame:
    """Mean PIX amount per member and day."""
    pix = tx.where(F.col("tipo").startswith("PIX") & F.col("associado_id").isNotNull())
    return pix.groupBy("associado_id", "dt").agg(F.avg("valor").alias("ticket_medio"))


def ewma_by_member(tx: DataFrame, params: Params) -> DataFrame:
    return ewma(pix_ticket(tx), "associado_id", "dt", "ticket_medio", params)


def hourly_volume(tx: DataFrame) -> DataFrame:
    """Transactions per branch, day and hour; hours without any have no row."""
    known = tx.where(F.col("agencia_id").isNotNull())
    hours = known.select(
        "agencia_id", F.to_date("dt_transacao").alias("dt"), F.hour("dt_transacao").alias("hora")
    )
    return hours.groupBy("agencia_id", "dt", "hora").agg(F.count(F.lit(1)).alias("qtd"))


def hourly_limits(tx: DataFrame, params: Params) -> DataFrame:
    """Rule D3 on raw transactions."""
    return limits(hourly_volume(tx), params)


def limits(hourly: DataFrame, params: Params) -> DataFrame:
    """Rule D3: branch hours outside mean ± width deviations of the branch's observed hours.

    A branch with a single observed hour has no deviation: no alert and a null score.
    """
    whole = Window.partitionBy("agencia_id")
    deviation = F.col("_sd")
    width = F.lit(params.sigma_width) * deviation
    upper = F.col("_mu") + width
    lower = F.greatest(F.lit(0.0), F.col("_mu") - width)
    outside = F.coalesce((F.col("qtd") > upper) | (F.col("qtd") < lower), F.lit(False))
    score = F.when(
        deviation.isNotNull(), clip01(F.abs(F.col("qtd") - F.col("_mu")) / width)
    )
    text = F.lit("Volume horário fora de 3 desvios padrão")
    return (
        hourly.withColumn("_mu", F.avg("qtd").over(whole))
        .withColumn("_sd", _zero_as_one(F.stddev_samp("qtd").over(whole)))
        .withColumn("alerta", outside)
        .select(
            "agencia_id",
            "dt",
            "hora",
            F.lit("D3_3SIGMA_HORA").alias("regra_id"),
            F.lit("CONTROLE_INTERNO").alias("familia"),
            "alerta",
            score.alias("score"),
            F.when(F.col("alerta"), text).alias("motivo"),
        )
    )


def _zero_as_one(deviation: Column) -> Column:
    return F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
