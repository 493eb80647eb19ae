"""JSON landing folder to partitioned Parquet with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txwatch.sources.schemas import TRANSACTION_STREAM


def read_landing(spark: SparkSession, landing: str, files_per_trigger: int = 10) -> DataFrame:
    reader = spark.readStream.schema(TRANSACTION_STREAM)
    return reader.option("maxFilesPerTrigger", files_per_trigger).json(landing)


def start_ingestion(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    drain: bool = False,
    files_per_trigger: int = 10,
) -> StreamingQuery:
    """Append new landing files to the bronze stream table, exactly once per checkpoint.

    `drain` stops after everything present has been taken in; otherwise the query keeps running.
    """
    writer = (
        read_landing(spark, landing, files_per_trigger)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("agencia_id")
        .outputMode("append")
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)
