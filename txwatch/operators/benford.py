"""Rule D4: conformity of first digits to Benford's law, per segment."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import clip01, first_digit
from txwatch.params import Params


def digit_counts(df: DataFrame, key: str, value: str = "valor") -> DataFrame:
    """Rows per segment and first digit; values without one are counted under digit 0."""
    digit = F.coalesce(first_digit(F.abs(F.col(value))), F.lit(0))
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(key, digit.alias("digito")).agg(F.count(F.lit(1)).alias("qtd"))


def digit_histogram(df: DataFrame, key: str, value: str = "valor") -> DataFrame:
    """All nine digits of every segment, seen or not, next to the expected frequency."""
    digits = [F.sum(F.when(F.col("digito") == d, F.col("qtd"))).alias(f"_{d}") for d in range(1, 10)]
    wide = digit_counts(df, key, value).groupBy(key).agg(
        F.sum("qtd").alias("linhas"),
        F.sum(F.when(F.col("digito") > 0, F.col("qtd"))).alias("total"),
        *digits,
    )
    cells = F.array(
        *[
            F.struct(F.lit(d).alias("digito"), F.coalesce(F.col(f"_{d}"), F.lit(0)).alias("qtd"))
            for d in range(1, 10)
        ]
    )
    expected = F.log10(F.lit(1.0) + F.lit(1.0) / F.col("digito"))
    return (
        wide.select(key, "linhas", F.coalesce("total", F.lit(0)).alias("total"), F.explode(cells))
        .select(key, "linhas", "total", "col.digito", "col.qtd")
        .withColumn("frequencia", F.try_divide(F.col("qtd"), F.col("total")))
        .withColumn("esperada", expected)
    )


def benford_statistics(df: DataFrame, key: str, params: Params, value: str = "valor") -> DataFrame:
    """chi2 (Pearson, 8 degrees of freedom), its p-value and MAD per segment.

    With an even number of degrees of freedom the chi-square tail is a finite sum. Fewer than
    benford_min_digits digits leave all three null.
    """
    observed, n = F.col("qtd"), F.col("total")
    expected = F.col("esperada") * n
    enough = n >= params.benford_min_digits
    half = F.col("chi2") / 2
    tail = F.exp(-half) * (1 + half + half * half / 2 + half * half * half / 6)
    return (
        digit_histogram(df, key, value)
        .groupBy(key, "linhas", "total")
        .agg(
            F.sum(
                F.when(enough, F.try_divide((observed - expected) * (observed - expected), expected))
            ).alias("chi2"),
            F.avg(F.when(enough, F.abs(F.col("frequencia") - F.col("esperada")))).alias("mad"),
        )
        .select(key, "linhas", "total", "chi2", tail.alias("p_value"), "mad")
    )


def benford_by_segment(
    df: DataFrame, params: Params, key: str = "tipo", value: str = "valor"
) -> DataFrame:
    """One finding per segment with at least benford_min_rows rows."""
    tested = benford_statistics(df, key, params, value)
    tested = tested.where(F.col("linhas") >= params.benford_min_rows)
    alert = F.coalesce((F.col("mad") > 0.015) | (F.col("p_value") < 0.01), F.lit(False))
    text = F.concat(
        F.lit("Benford: MAD="),
        F.format_number("mad", 4),
        F.lit(", p="),
        F.format_number("p_value", 4),
        F.lit(f" ({key}="),
        F.col(key).cast("string"),
        F.lit(")"),
    )
    return tested.withColumn("alerta", alert).select(
        F.col(key).cast("string").alias("chave"),
        F.lit("D4_BENFORD").alias("regra_id"),
        F.lit("FRAUDE").alias("familia"),
        "alerta",
        "chi2",
        "p_value",
        "mad",
        F.coalesce(clip01((F.col("mad") - 0.006) / 0.020), F.lit(0.0)).alias("score"),
        F.when(F.col("alerta"), text).alias("motivo"),
    )


def benford_cube(
    df: DataFrame, params: Params, keys: tuple[str, ...] = ("tipo", "ano_mes"),
    levels: tuple[tuple[str, ...], ...] | None = None, value: str = "valor",
) -> DataFrame:
    """Rule D4 at several levels at once: one finding per level and cell with at least benford_min_rows rows.

    `levels` names the key columns of each level; by default every set of `keys`, the whole table included. Digits
    are counted once in the finest cells; the levels are grouping sets over these counts, nine numbers a cell. A
    row whose key is null takes part only in levels without that key. `chave` joins the cell's values.
    """
    levels = levels or tuple(s for n in range(len(keys), -1, -1) for s in combinations(keys, n))
    digit = F.coalesce(first_digit(F.abs(F.col(value))), F.lit(0))
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("linhas"), *[F.count_if(digit == d).alias(f"_{d}") for d in range(1, 10)]
    )
    part = [F.grouping(k).alias(f"_out_{k}") for k in keys]
    rolled = counted.groupingSets([[F.col(k) for k in level] for level in levels], *[F.col(k) for k in keys]).agg(
        *part, F.sum("linhas").alias("linhas"), *[F.sum(f"_{d}").alias(f"_{d}") for d in range(1, 10)]
    )
    for k in keys:
        rolled = rolled.where((F.col(f"_out_{k}") == 1) | F.col(k).isNotNull())
    total = sum((F.col(f"_{d}") for d in range(1, 10)), F.lit(0))
    rolled = rolled.where(F.col("linhas") >= params.benford_min_rows).withColumn("total", total)
    n, chi2, gap = F.col("total"), F.lit(0.0), F.lit(0.0)
    for d in range(1, 10):
        share = math.log10(1 + 1 / d)
        expected = n * F.lit(share)
        chi2 = chi2 + F.try_divide((F.col(f"_{d}") - expected) * (F.col(f"_{d}") - expected), expected)
        gap = gap + F.abs(F.try_divide(F.col(f"_{d}"), n) - F.lit(share))
    enough, half = n >= params.benford_min_digits, F.col("chi2") / 2
    tested = (
        rolled.withColumn("chi2", F.when(enough, chi2)).withColumn("mad", F.when(enough, gap / 9))
        .withColumn("p_value", F.exp(-half) * (1 + half + half * half / 2 + half * half * half / 6))
    )
    alert = F.coalesce((F.col("mad") > 0.015) | (F.col("p_value") < 0.01), F.lit(False))
    level = F.concat_ws("+", *[F.when(F.col(f"_out_{k}") == 0, F.lit(k)) for k in keys])
    cell = F.concat_ws("|", *[F.when(F.col(f"_out_{k}") == 0, F.col(k).cast("string")) for k in keys])
    text = F.concat(
        F.lit("Benford: MAD="), F.format_number("mad", 4), F.lit(", p="), F.format_number("p_value", 4),
        F.lit(" ("), F.when(F.col("nivel") == "", F.lit("tudo")).otherwise(F.concat_ws("=", "nivel", "chave")), F.lit(")"),
    )
    tested = tested.withColumns({"alerta": alert, "nivel": level, "chave": cell})
    return tested.select(
        "nivel", "chave", F.lit("D4_BENFORD").alias("regra_id"), F.lit("FRAUDE").alias("familia"), "alerta", "linhas",
        "total", "chi2", "p_value", "mad", F.coalesce(clip01((F.col("mad") - 0.006) / 0.020), F.lit(0.0)).alias("score"),
        F.when(F.col("alerta"), text).alias("motivo"),
    )
