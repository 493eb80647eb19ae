"""Session defaults and the shared scratch area."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "txwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for; `conf` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call-site capture for every column expression makes building large plans slow.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where that is unset, one inside the warehouse,
    which driver and executors share under every master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage, survives the loss of executors and keeps column pruning for later scans.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
