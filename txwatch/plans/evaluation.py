"""Drift and detection quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.session import materialise

_FLOOR = 1e-4


def psi_by_period(
    df: DataFrame, value: str, period: Column, baseline: Column, bins: int = 10
) -> DataFrame:
    """Population stability index of `value` per period against the rows meeting `baseline`.

    Bins are the baseline's quantile bins; shares are floored at 1e-4 before the logarithm. Value, period and
    baseline mark are stored first, as edges and counts read them several times.
    """
    rows = df.where(F.col(value).isNotNull()).select(
        F.col(value).alias("_v"), period.alias("periodo"), baseline.alias("_base")
    )
    rows = materialise(rows, "psi")
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(rows.where("_base"), "_v", probs)
    edges = cuts.agg(F.array_sort(F.collect_list("quantil")).alias("_edges"))
    above = [F.when(F.get("_edges", F.lit(k)) < F.col("_v"), 1).otherwise(0) for k in range(len(probs))]
    slot = reduce(Column.__add__, above, F.lit(0))
    counts = (
        rows.crossJoin(F.broadcast(edges))
        .groupBy("periodo", "_base", slot.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def shares(kind: Column, prefix: str) -> list[Column]:
        return [
            F.sum(F.when(kind & (F.col("_bin") == b), F.col("_n")).otherwise(0)).alias(f"{prefix}{b}")
            for b in range(bins)
        ]

    every = F.lit(True)
    actual = counts.groupBy("periodo").agg(*shares(every, "a"), F.sum("_n").alias("qtd"))
    expected = counts.where("_base").agg(*shares(every, "e"), F.sum("_n").alias("_base_n"))
    both = actual.crossJoin(F.broadcast(expected))
    psi = F.lit(0.0)
    for b in range(bins):
        a = F.greatest(F.col(f"a{b}") / F.col("qtd"), F.lit(_FLOOR))
        e = F.greatest(F.col(f"e{b}") / F.col("_base_n"), F.lit(_FLOOR))
        psi = psi + (a - e) * F.log(a / e)
    return both.select("periodo", "qtd", psi.alias("psi"))


BASELINE_SCHEMA = "variavel string, faixa int, borda double, parte double"


def _long(df: DataFrame, columns: tuple[str, ...], *others: Column) -> DataFrame:
    """One row per value: `others`, variavel, _v. Nulls and NaN are left out."""
    cells = ", ".join(f"'{c}', cast({c} as double)" for c in columns)
    rows = df.select(*others, F.expr(f"stack({len(columns)}, {cells}) as (variavel, _v)"))
    return rows.where("_v is not null and not isnan(_v)")


def feature_baseline(df: DataFrame, columns: tuple[str, ...], bins: int = 10) -> DataFrame:
    """(variavel, faixa, borda, parte): per column the upper edges of its quantile bins and each bin's share.

    At most bins rows a column, to be stored with the model and compared with later batches. The last bin has
    no edge. A column without values has no rows. `df` is read several times and should be a stored table.
    """
    rows = _long(df, columns)
    cuts = exact_quantiles(rows, "_v", [i / bins for i in range(1, bins)], ("variavel",))
    edges = cuts.groupBy("variavel").agg(F.array_sort(F.collect_list("quantil")).alias("_edges"))
    counts = rows.join(F.broadcast(edges), "variavel").groupBy("variavel", _slot().alias("faixa"))
    counts = counts.agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("variavel").agg(F.sum("_n").alias("_all"))
    every = edges.join(totals, "variavel").withColumn("faixa", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, ["variavel", "faixa"], "left").select(
        "variavel", "faixa", F.get("_edges", F.col("faixa")).alias("borda"),
        F.coalesce(F.col("_n") / F.col("_all"), F.lit(0.0)).alias("parte"),
    )


def _slot() -> Column:
    """Number of edges below the value."""
    return F.size(F.filter("_edges", lambda e: e < F.col("_v")))


def feature_drift(df: DataFrame, baseline: DataFrame, period: Column, columns: tuple[str, ...]) -> DataFrame:
    """(variavel, periodo, qtd, psi): stability index of every column and period against a stored baseline.

    All columns are compared in one aggregate over (variavel, periodo, faixa); shares are floored at 1e-4.
    """
    kept = baseline.groupBy("variavel").agg(
        F.array_sort(F.collect_list("borda")).alias("_edges"),
        F.transform(F.array_sort(F.collect_list(F.struct("faixa", "parte"))), lambda s: s["parte"]).alias("_shares"),
    )
    rows = _long(df, columns, period.alias("periodo")).join(F.broadcast(kept.select("variavel", "_edges")), "variavel")
    counts = rows.groupBy("variavel", "periodo", _slot().alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.groupBy("variavel", "periodo").agg(
        F.sum("_n").alias("qtd"), F.map_from_entries(F.collect_list(F.struct("_bin", "_n"))).alias("_counts")
    )
    share = F.transform(
        "_shares",
        lambda e, b: F.struct(
            F.greatest(F.coalesce(F.element_at("_counts", b), F.lit(0)) / F.col("qtd"), F.lit(_FLOOR)).alias("a"),
            F.greatest(e, F.lit(_FLOOR)).alias("e"),
        ),
    )
    psi = F.aggregate(share, F.lit(0.0), lambda t, s: t + (s["a"] - s["e"]) * F.log(s["a"] / s["e"]))
    return found.join(F.broadcast(kept.select("variavel", "_shares")), "variavel").select(
        "variavel", "periodo", "qtd", psi.alias("psi")
    )


def precision_at_k(scored: DataFrame, k: int) -> DataFrame:
    """Share of labelled frauds among the k best scores. `scored` has transacao_id, score and
    fraude_label."""
    best = scored.orderBy(F.desc_nulls_last("score"), "transacao_id").limit(k)
    hits = F.count_if(F.coalesce("fraude_label", F.lit(False)))
    return best.agg(
        F.count(F.lit(1)).alias("k"),
        hits.alias("acertos"),
        F.try_divide(hits, F.count(F.lit(1))).alias("precisao"),
    )


def recall_by_type(scored: DataFrame, cut: float) -> DataFrame:
    """Share of each fraud type whose score reaches `cut`."""
    frauds = scored.where(F.col("fraude_label"))
    found = F.count_if(F.col("score") >= cut)
    return frauds.groupBy("fraude_tipo").agg(
        F.count(F.lit(1)).alias("fraudes"),
        found.alias("detectadas"),
        F.try_divide(found, F.count(F.lit(1))).alias("recall"),
    )
