"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.params import Params

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS


def wall_micros(name: str) -> Column:
    """Microseconds since 1970-01-01 on the wall clock, the same in every session zone."""
    return F.expr(
        f"unix_date(cast({name} as date)) * 86400000000L + hour({name}) * 3600000000L "
        f"+ minute({name}) * 60000000L + cast(extract(second from {name}) * 1000000 as bigint)"
    )


def first_digit(value: Column) -> Column:
    """First significant digit, read off the decimal text; null where there is none."""
    digits = F.ltrim(value.cast("string"), F.lit("-0."))
    return F.substring(digits, 1, 1).try_cast("int")


def clip01(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def positive_or_one(deviation: Column) -> Column:
    """A standard deviation fit for division: zero and single-point series count as 1."""
    return F.when(deviation > 0, deviation).otherwise(F.lit(1.0))


def off_hours(hour: Column, params: Params) -> Column:
    return (hour < params.opening_hour) | (hour >= params.closing_hour)


def severity(score: Column, params: Params) -> Column:
    """Band name of a score, null below the lowest band."""
    bands = sorted(params.severity_bands, reverse=True)
    (edge, name), rest = bands[0], bands[1:]
    chain = F.when(score >= edge, F.lit(name))
    for edge, name in rest:
        chain = chain.when(score >= edge, F.lit(name))
    return chain


def sorted_distinct(text: Column, separator: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(text)), separator)


def no_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in all floating-point columns."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floating else F.col(c) for c in df.columns])
