"""Rule D5: amounts kept below the reporting limit whose rolling total exceeds it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import MICROS, wall_micros
from txwatch.functions.hotkeys import sliced_running_sums
from txwatch.params import Params

# Money is added as exact decimals: a rolling total then does not depend on the order of additions,
# and what left the window can be subtracted without residue.
_MONEY = "decimal(26,10)"
_SUM = "decimal(36,10)"


def structuring_windows(tx: DataFrame, params: Params) -> DataFrame:
    """Per member and instant: qtd and soma at that instant, qtd_janela and soma_janela over the
    window (t - hours, t], and whether that window is suspicious.

    A window total is the total so far less the total of what has left the window: every instant is
    marked where it enters and where it leaves, and running totals over the marks take linear time.
    Transactions of the same instant share one row, and a member's time line is cut into slices.
    """
    small = tx.where(
        F.col("tipo").isin(*params.structuring_types)
        & (F.col("valor") < params.structuring_limit)
        & F.col("associado_id").isNotNull()
    ).select("associado_id", "dt_transacao", "valor")
    rolled = _rolled(small, params)
    return rolled.selectExpr(
        "*",
        f"soma_janela > cast({params.structuring_limit!r}D as {_SUM}) "
        f"and qtd_janela >= {params.structuring_min_tx} as suspeita",
    )


def _instants(small: DataFrame) -> DataFrame:
    totals = small.groupBy("associado_id", "dt_transacao").agg(
        F.expr("count(*) as qtd"),
        F.expr(f"cast(sum(cast(valor as {_MONEY})) as {_SUM}) as soma"),
    )
    return totals.select("*", wall_micros("dt_transacao").alias("_t"))


def _rolled(small: DataFrame, params: Params) -> DataFrame:
    stay = params.structuring_hours * 3600 * MICROS
    both = F.expr(
        "explode(array(struct(_t as t, true as enters), "
        f"struct(_t + {stay} as t, false as enters))) as _mark"
    )
    marks = _instants(small).select("associado_id", "dt_transacao", "qtd", "soma", both).selectExpr(
        "associado_id",
        "_mark.t as _t",
        "if(_mark.enters, dt_transacao, null) as dt_transacao",
        "qtd",
        "soma",
        "if(_mark.enters, qtd, -qtd) as qtd_janela",
        f"cast(if(_mark.enters, soma, -soma) as {_SUM}) as soma_janela",
    )
    width = params.slice_seconds * MICROS
    rolled = sliced_running_sums(marks, "associado_id", "_t", ["qtd_janela", "soma_janela"], width)
    return rolled.where("dt_transacao is not null").drop("_t")


def structuring(tx: DataFrame, params: Params) -> DataFrame:
    """One finding per member and day with suspicious windows; soma adds the suspicious rows only."""
    hits = structuring_windows(tx, params).where("suspeita")
    daily = hits.groupBy("associado_id", F.to_date("dt_transacao").alias("dt")).agg(
        F.sum("qtd").alias("qtd_tx"), F.sum("soma").cast("double").alias("soma")
    )
    text = F.concat(
        F.lit("Fracionamento: "),
        F.col("qtd_tx").cast("string"),
        F.lit(" tx somando R$ "),
        F.format_number("soma", 2),
        F.lit(f" em {params.structuring_hours}h"),
    )
    score = F.least(F.col("soma") / params.structuring_limit, F.lit(2.0)) / 2.0
    return daily.select(
        "associado_id",
        "dt",
        "qtd_tx",
        "soma",
        F.lit("D5_FRACIONAMENTO").alias("regra_id"),
        F.lit("PLD").alias("familia"),
        F.lit(True).alias("alerta"),
        score.alias("score"),
        text.alias("motivo"),
    )
