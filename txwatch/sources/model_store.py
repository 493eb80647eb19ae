"""Fitted models as tables: train today, score tomorrow.

A store is a folder with one sub-folder per version and a manifest of versions and the models they hold. Forest
nodes, weights and metrics are Parquet. All sizes are those of the models.
"""

from __future__ import annotations

import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.operators.autoencoder import AutoencoderModel
from txwatch.operators.calibrator import Calibrator
from txwatch.plans.evaluation import BASELINE_SCHEMA
from txwatch.plans.medallion import Models, model_metrics

_NUMBERS = "nome string, posicao int, valor double"
_ARRAYS = _CALIBRATOR_ARRAYS = ("weights", "mean", "deviation")
_MANIFEST = "versao long, pasta string, modelos array<string>"


def _numbers(model: AutoencoderModel) -> list[tuple[str, int, float]]:
    rows = [(name, k, float(v)) for name in _ARRAYS for k, v in enumerate(getattr(model, name))]
    rows.append(("threshold", 0, float(model.threshold)))
    rows += [(f"history_{field}", k, float(entry[field])) for k, entry in enumerate(model.history) for field in range(3)]
    return rows + [(f"column:{name}", k, 0.0) for k, name in enumerate(model.columns)]


def _calibrator_numbers(model: Calibrator) -> list[tuple[str, int, float]]:
    rows = [(name, k, float(v)) for name in _CALIBRATOR_ARRAYS for k, v in enumerate(getattr(model, name))]
    return rows + [(name, 0, float(getattr(model, name))) for name in ("intercept", "auc", "rows")]


def save_models(spark: SparkSession, models: Models, path: str) -> str:
    """Write the models at hand and their metrics to a new version below `path`, then enter it in the manifest.

    Versions are never overwritten, so tables that are still being read lazily stay; the manifest is appended to
    last, and readers take its newest entry. Returns the version's folder.
    """
    folder = f"{path}/{uuid.uuid4().hex}"
    present = []
    if models.forest_nodes is not None:
        models.forest_nodes.write.parquet(f"{folder}/isolation_forest")
        facts = [("group", models.forest_group, None), ("p99", None, models.forest_p99)]
        spark.createDataFrame(facts, "nome string, texto string, valor double").coalesce(1).write.parquet(f"{folder}/forest_facts")
        present.append("isolation_forest")
    if models.baseline is not None:
        models.baseline.coalesce(1).write.parquet(f"{folder}/baseline")
        present.append("baseline")
    for name, model, numbers in (
        ("autoencoder", models.autoencoder, _numbers), ("calibrator", models.calibrator, _calibrator_numbers)
    ):
        if model is not None:
            spark.createDataFrame(numbers(model), _NUMBERS).coalesce(1).write.parquet(f"{folder}/{name}")
            present.append(name)
    model_metrics(spark, models).coalesce(1).write.parquet(f"{folder}/metrics")
    entry = spark.createDataFrame([(time.time_ns(), folder, present)], _MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return folder


def _newest(spark: SparkSession, path: str) -> tuple[str, set[str]]:
    row = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").agg(F.max_by(F.struct("pasta", "modelos"), "versao")).first()[0]
    return row["pasta"], set(row["modelos"])


def _read_numbers(spark: SparkSession, folder: str) -> tuple[dict[str, list[float]], list[str]]:
    """Values by name in order, and the names of columns."""
    rows = spark.read.schema(_NUMBERS).parquet(folder).orderBy("nome", "posicao").collect()
    parts: dict[str, list[float]] = {}
    for row in rows:
        parts.setdefault(row["nome"], []).append(row["valor"])
    columns = sorted((r["posicao"], r["nome"].partition(":")[2]) for r in rows if r["nome"].startswith("column:"))
    return parts, [name for _, name in columns]


def load_models(spark: SparkSession, path: str) -> Models:
    """The newest models that `path` holds; scoring leaves out those that it does not hold."""
    folder, present = _newest(spark, path)
    nodes: DataFrame | None = None
    network: AutoencoderModel | None = None
    fitted: Calibrator | None = None
    group, p99 = None, None
    if "isolation_forest" in present:
        nodes = spark.read.parquet(f"{folder}/isolation_forest")
        facts = {r["nome"]: r for r in spark.read.parquet(f"{folder}/forest_facts").collect()}
        group, p99 = facts["group"]["texto"], facts["p99"]["valor"]
    if "autoencoder" in present:
        parts, columns = _read_numbers(spark, f"{folder}/autoencoder")
        steps = zip(*(parts.get(f"history_{field}", []) for field in range(3)))
        network = AutoencoderModel(
            *(np.array(parts[name]) for name in _ARRAYS), parts["threshold"][0],
            [(int(done), loss, held) for done, loss, held in steps], tuple(columns),
        )
    if "calibrator" in present:
        parts, _ = _read_numbers(spark, f"{folder}/calibrator")
        arrays = (np.array(parts[name]) for name in _CALIBRATOR_ARRAYS)
        fitted = Calibrator(*arrays, parts["intercept"][0], parts["auc"][0], int(parts["rows"][0]))
    baseline = spark.read.schema(BASELINE_SCHEMA).parquet(f"{folder}/baseline") if "baseline" in present else None
    return Models(nodes, network, fitted, p99, group, baseline)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{_newest(spark, path)[0]}/metrics").orderBy(F.col("modelo"), F.col("metrica"), F.col("passo"))
