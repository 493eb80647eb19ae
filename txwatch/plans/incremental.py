"""Incremental runs: new transactions enter silver, and only the days and months they touch are refreshed.

Silver and the daily facts are kept in folders per day, the monthly fact in folders per month; refreshed folders
replace the old ones, so a run that is repeated after a failure, or a batch that is delivered twice, changes
nothing. A stored transaction is final: a later delivery of its id is a copy. Silver therefore only grows.

Distinct counts do not add up over days, so the monthly fact rests on a stored key table: per day, member and month
one row of sums and one per payee and channel. A month is put together from the rows of its days; transactions of
untouched days are not read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txwatch.operators import facts, silver
from txwatch.params import Params
from txwatch.plans.medallion import Dimensions
from txwatch.session import materialise
from txwatch.sources.schemas import TRANSACTION_COLUMNS
from txwatch.sources.tables import read_table, wall_clock, write_silver
from txwatch.streaming.ingest import read_landing

#: Table names below the root of a lake.
SILVER, KEYS, BRANCH_DAY, OPERATOR_DAY, MEMBER_MONTH = (
    "silver/transacoes_silver", "gold/chaves_associado_dia", "gold/fato_agencia_dia", "gold/fato_operador_dia",
    "gold/fato_associado_mes",
)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_table(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace(df: DataFrame, path: str, folder: str) -> None:
    """Replaces the folders that `df` has rows for; the others stay."""
    dealt = df.hint("rebalance", F.col(folder))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)


def _only(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of a few folders, as a filter that prunes them."""
    return df.where(F.col(column).isin(values)) if values else df.limit(0)


def add_to_silver(spark: SparkSession, arrived: DataFrame, dims: Dimensions, root: str, params: Params) -> list:
    """Takes new raw transactions into silver; returns the days that gained rows.

    Copies among the new rows go by the rule of `silver.clean`; ids that silver holds already are dropped by one
    join over the id column alone. Only the touched days are read in full and written again.
    """
    path = f"{root}/{SILVER}"
    old = _stored(spark, path)
    fresh = silver.clean(arrived.select(*[c for c in TRANSACTION_COLUMNS if c in arrived.columns]))
    if old is not None:
        fresh = fresh.join(old.select("transacao_id"), "transacao_id", "left_anti")
    fresh = materialise(silver.enrich(fresh, dims.members, dims.branches, dims.days, params), "fresh-silver")
    days = [r["dt"] for r in fresh.select("dt").distinct().collect()]  # folders to replace
    if not days:
        return days
    if old is not None:
        # What is read from the folders to be replaced is set aside before they are.
        kept = materialise(_only(old, "dt", days), "touched-silver")
        fresh = kept.unionByName(fresh, allowMissingColumns=True)
    write_silver(fresh, path)
    return days


def _member_keys(tx: DataFrame) -> DataFrame:
    """Per day, member and month: a row of sums (especie 'tx') and one per payee and channel seen."""
    month = F.date_format("dt", "yyyy-MM")
    base = tx.select("dt", "associado_id", month.alias("ano_mes"), "valor", "conta_destino", "canal")
    by = ["dt", "associado_id", "ano_mes"]
    sums = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("valor").alias("soma"))
    sums = sums.select(*by, F.lit("tx").alias("especie"), F.lit(None).cast("string").alias("chave"), "n", "soma")
    seen = base.select(*by, F.expr("stack(2, 'destino', conta_destino, 'canal', canal) as (especie, chave)"))
    seen = seen.where("chave is not null").distinct()
    return sums.unionByName(seen, allowMissingColumns=True)


def _member_month(keys: DataFrame) -> DataFrame:
    """The monthly fact from the key rows of all its days; equal keys of several days count once."""
    by = ["associado_id", "ano_mes"]
    merged = keys.groupBy(*by, "especie", "chave").agg(F.sum("n").alias("n"), F.sum("soma").alias("soma"))
    return merged.groupBy(*by).agg(
        F.sum("n").alias("qtd_tx"), F.sum("soma").alias("valor_total"), (F.sum("soma") / F.sum("n")).alias("ticket_medio"),
        F.count_if(F.col("especie") == "destino").alias("destinos_unicos"),
        F.count_if(F.col("especie") == "canal").alias("canais_distintos"),
    )


def refresh_gold(spark: SparkSession, days: list, root: str) -> None:
    """Brings the three facts up to date after `days` of silver have changed. A run for the same days again, for
    instance after a failure half-way, writes the same folders again."""
    if not days:
        return
    touched = _only(read_table(spark, f"{root}/{SILVER}"), "dt", days)
    _replace(facts.branch_day(touched), f"{root}/{BRANCH_DAY}", "dt")
    _replace(facts.operator_day(touched), f"{root}/{OPERATOR_DAY}", "dt")
    _replace(_member_keys(touched), f"{root}/{KEYS}", "dt")
    months = sorted({day.strftime("%Y-%m") for day in days})
    span = f"date_format(dt, 'yyyy-MM') in ({', '.join(repr(m) for m in months)})"
    keys = spark.read.option("basePath", f"{root}/{KEYS}").parquet(f"{root}/{KEYS}").where(span)
    _replace(_member_month(keys), f"{root}/{MEMBER_MONTH}", "ano_mes")


def refresh(spark: SparkSession, arrived: DataFrame, dims: Dimensions, root: str, params: Params | None = None) -> list:
    """One incremental run: silver, then the facts of the days that changed; returns these days."""
    days = add_to_silver(spark, arrived, dims, root, params or Params())
    refresh_gold(spark, days, root)
    return days


def start_silver_stream(
    spark: SparkSession,
    landing: str,
    dims: Dimensions,
    root: str,
    checkpoint: str,
    params: Params | None = None,
    lateness: str = "2 days",
    drain: bool = False,
    files_per_trigger: int = 10,
) -> StreamingQuery:
    """JSON drops straight into silver.

    Time in the stream is the arrival of the files, not the date of their rows, so late days are taken in like any
    other. Copies that arrive within `lateness` of each other are dropped by the stream's own state, which the
    watermark bounds; older ones meet the ids that silver holds. A micro-batch that is replayed changes nothing.
    """

    def take_in(batch: DataFrame, _: int) -> None:
        add_to_silver(batch.sparkSession, wall_clock(batch), dims, root, params or Params())

    rows = read_landing(spark, landing, files_per_trigger).withColumn("_seen", F.col("_metadata.file_modification_time"))
    usable = rows.where("transacao_id is not null and valor > 0 and dt_transacao is not null")
    once = usable.withWatermark("_seen", lateness).dropDuplicatesWithinWatermark(["transacao_id"]).drop("_seen")
    writer = once.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()
