"""Readers and writers of the bronze, silver, gold and alert tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txwatch.functions.columns import no_nan
from txwatch.sources.schemas import ALERTS


def read_bronze(
    spark: SparkSession,
    paths: str | Sequence[str],
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Raw transactions from one or several Parquet folders (batch drops and stream output).

    `since`/`until` (inclusive dates) prune `dt_partition` folders where the layout has them and
    otherwise reach the scan as filters on dt_transacao.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = None
    for path in paths:
        part = read_table(spark, path)
        if "dt_partition" in part.columns:
            if since:
                part = part.where(F.col("dt_partition") >= F.lit(since).cast("date"))
            if until:
                part = part.where(F.col("dt_partition") <= F.lit(until).cast("date"))
            part = part.drop("dt_partition")
        if since:
            part = part.where(F.col("dt_transacao") >= F.lit(since).cast("timestamp_ntz"))
        if until:
            part = part.where(
                F.col("dt_transacao") < F.expr(f"cast(date_add(date'{until}', 1) as timestamp_ntz)")
            )
        part = wall_clock(part)
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    return raw


def wall_clock(df: DataFrame) -> DataFrame:
    """Zoned instants become wall-clock time in the session zone, NaN becomes null."""
    df = no_nan(df)
    zoned = {name for name, kind in df.dtypes if kind == "timestamp"}
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns]
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table. Branch codes used as folder names stay text (0017 must not become 17)."""
    stored = spark.read.option("basePath", path).parquet(path)
    kept = StructType(
        [StructField(f.name, StringType()) if f.name == "agencia_id" else f for f in stored.schema]
    )
    if kept == stored.schema:
        return stored
    return spark.read.schema(kept).option("basePath", path).parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alert files of a folder, with the nine contract columns and their types."""
    stored = spark.read.parquet(path)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ALERTS])


def _write_daily(df: DataFrame, path: str, day: str, by_branch: bool) -> None:
    """One folder per day, rows sorted by branch inside, so that row-group statistics prune branches.

    Days already stored and not in `df` stay; days in `df` are replaced. Branch folders below the days are
    an option for few branches. Rebalancing puts each folder's rows together, so few files are written per
    folder, and lets adaptive execution cut an oversized folder into several tasks.
    """
    by = (day, "agencia_id") if by_branch else (day,)
    dealt = df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(day, "agencia_id")
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def write_bronze(df: DataFrame, path: str, by_branch: bool = False) -> None:
    _write_daily(df.withColumn("dt_partition", F.to_date("dt_transacao")), path, "dt_partition", by_branch)


def write_silver(df: DataFrame, path: str, by_branch: bool = False) -> None:
    _write_daily(df, path, "dt", by_branch)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_alerts(df: DataFrame, path: str) -> None:
    write_table(df.select(*ALERTS.fieldNames()), path)
