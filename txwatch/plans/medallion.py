"""The batch run: silver, gold, models and alerts, each a lazy plan ending in one write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.operators import autoencoder as ae
from txwatch.operators import benford, control_charts, facts, features, scoring, silver, structuring
from txwatch.operators import isolation_forest as forest
from txwatch.operators.calibrator import Calibrator
from txwatch.params import Params
from txwatch.plans import evaluation
from txwatch.session import materialise
from txwatch.sources.tables import read_table, write_alerts, write_silver, write_table


@dataclass(frozen=True)
class Dimensions:
    members: DataFrame
    branches: DataFrame
    days: DataFrame


@dataclass(frozen=True)
class Models:
    """Trained models; any may be missing, its rule is then skipped."""

    forest_nodes: DataFrame | None = None
    autoencoder: ae.AutoencoderModel | None = None
    calibrator: Calibrator | None = None
    #: 99th percentile of the forest's raw scores on the training rows.
    forest_p99: float | None = None
    #: Column whose values have a forest each; None: one forest for all rows.
    forest_group: str | None = None
    #: Quantile bins and shares of the features at training time, for drift.
    baseline: DataFrame | None = None


def silver_plan(bronze: DataFrame, dims: Dimensions, params: Params) -> DataFrame:
    return silver.enrich(silver.clean(bronze), dims.members, dims.branches, dims.days, params)


def gold_plans(silver_table: DataFrame) -> dict[str, DataFrame]:
    return {
        "fato_agencia_dia": facts.branch_day(silver_table),
        "fato_operador_dia": facts.operator_day(silver_table),
        "fato_associado_mes": facts.member_month(silver_table),
    }


def statistical_findings(tx: DataFrame, params: Params) -> list[DataFrame]:
    """Rules D1 to D5 over silver transactions."""
    branch_days, branch_hours = control_charts.volume_findings(tx, params)
    return [
        branch_days,
        control_charts.ewma_by_member(tx, params),
        branch_hours,
        benford.benford_by_segment(tx, params),
        structuring.structuring(tx, params),
    ]


def feature_matrix(silver_table: DataFrame, models: Models, params: Params) -> DataFrame | None:
    """The stored features that the forest and the drift table need; None where neither is at hand."""
    if models.forest_nodes is None and models.baseline is None:
        return None
    keep = dict.fromkeys(c for c in ("dt", models.forest_group) if c in silver_table.columns)
    return materialise(features.member_features(silver_table, params, tuple(keep)), "features")


def model_findings(
    silver_table: DataFrame, models: Models, params: Params, matrix: DataFrame | None = None
) -> list[DataFrame]:
    """Rules M1 and M2 for the models at hand."""
    found = []
    if models.forest_nodes is not None:
        by = models.forest_group
        matrix = feature_matrix(silver_table, models, params) if matrix is None else matrix
        raw = materialise(forest.forest_scores(matrix, models.forest_nodes, group=by), "forest-scores")
        found.append(forest.normalise(raw))
    if models.autoencoder is not None:
        profile = facts.member_profile(silver_table, params)
        found.append(ae.autoencoder_findings(profile, models.autoencoder))
    return found


def alerts_plan(
    silver_table: DataFrame, run_at: str, params: Params, models: Models | None = None, matrix: DataFrame | None = None
) -> DataFrame:
    detected = statistical_findings(silver_table, params)
    detected += model_findings(silver_table, models or Models(), params, matrix)
    combined = scoring.combine_scores(silver_table.sparkSession, detected, params)
    return scoring.build_alerts(combined, run_at)


def train_models(
    silver_table: DataFrame, params: Params, seed: int = 42, forest_group: str | None = None, epochs: int = 40
) -> Models:
    """Features and profiles are written once and then read by every training step."""
    keep = (forest_group,) if forest_group else ()
    matrix = materialise(features.member_features(silver_table, params, keep), "features")
    nodes = forest.grow_forest(matrix, seed=seed, group=forest_group)
    nodes = materialise(nodes, "forest")
    raw = materialise(forest.forest_scores(matrix, nodes, group=forest_group), "forest-scores")
    top = exact_quantiles(raw, "bruto", [0.99]).first()
    profile = materialise(facts.member_profile(silver_table, params), "profiles")
    network = ae.train_autoencoder(profile, epochs=epochs, seed=seed)
    baseline = materialise(evaluation.feature_baseline(matrix, features.FEATURE_COLUMNS), "baseline")
    return Models(nodes, network, None, top["quantil"] if top else None, forest_group, baseline)


def model_metrics(spark: SparkSession, models: Models) -> DataFrame:
    """Losses per training round, thresholds and validation figures as rows (modelo, metrica, passo, valor)."""
    rows: list[tuple[str, str, int, float]] = []
    if models.autoencoder is not None:
        for step, loss, held in models.autoencoder.history:
            rows += [("autoencoder", "train_loss", step, float(loss)), ("autoencoder", "val_loss", step, float(held))]
        last = models.autoencoder.history[-1][0] if models.autoencoder.history else 0
        rows.append(("autoencoder", "threshold_p99", last, float(models.autoencoder.threshold)))
    if models.forest_p99 is not None:
        rows.append(("isolation_forest", "score_p99", 0, float(models.forest_p99)))
    if models.calibrator is not None:
        rows.append(("calibrator", "val_auc", 0, float(models.calibrator.auc)))
        rows.append(("calibrator", "n_train", 0, float(models.calibrator.rows)))
    return spark.createDataFrame(rows, "modelo string, metrica string, passo int, valor double")


def run_batch(
    spark: SparkSession,
    bronze: DataFrame,
    dims: Dimensions,
    root: str,
    run_at: str,
    params: Params | None = None,
    models: Models | None = None,
) -> dict[str, str]:
    """Write silver, the three gold facts and the alert table under `root`; returns their paths.

    Later steps read the stored silver table, so cleaning and joins run once. With models their metrics are written
    too, and with a baseline the drift of every feature by month.
    """
    params = params or Params()
    paths = {"silver": f"{root}/silver/transacoes_silver"}
    write_silver(silver_plan(bronze, dims, params), paths["silver"])
    stored = read_table(spark, paths["silver"])
    for name, plan in gold_plans(stored).items():
        paths[name] = f"{root}/gold/{name}"
        write_table(plan, paths[name])
    paths["alertas_auditoria"] = f"{root}/gold/alertas_auditoria"
    matrix = feature_matrix(stored, models, params) if models else None
    write_alerts(alerts_plan(stored, run_at, params, models, matrix), paths["alertas_auditoria"])
    if models:
        paths["model_metrics"] = f"{root}/gold/model_metrics"
        write_table(model_metrics(spark, models), paths["model_metrics"])
    if models and models.baseline is not None:
        paths["deriva_variaveis"] = f"{root}/gold/deriva_variaveis"
        month = F.date_format("dt", "yyyy-MM")
        write_table(evaluation.feature_drift(matrix, models.baseline, month, features.FEATURE_COLUMNS), paths["deriva_variaveis"])
    return paths


def severity_report(alerts: DataFrame) -> DataFrame:
    return scoring.severity_distribution(alerts).orderBy(F.desc("qtd"), "severidade")
