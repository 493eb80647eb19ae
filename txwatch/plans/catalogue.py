"""Every operator as a named query over the sample tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.functions.columns import severity
from txwatch.functions.quantiles import exact_quantiles
from txwatch.operators import autoencoder as ae
from txwatch.operators import benford, calibrator, control_charts, evidence, facts, features, feedback, scoring, silver
from txwatch.operators import isolation_forest as forest
from txwatch.operators import structuring as pld
from txwatch.params import SEVERITY_BANDS, Params
from txwatch.plans import cockpit, evaluation, incremental, medallion
from txwatch.session import materialise, scratch_path
from txwatch.sources import sample_map, tables
from txwatch.sources.model_store import load_models, save_models
from txwatch.sources.schemas import TRANSACTION_COLUMNS
from txwatch.streaming.ingest import start_ingestion

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = Params()
RUN_AT = "2024-02-15 00:00:00"
AS_OF = "2024-02-15"
# A tighter chart, so that the sample tables reach the alert branch of the CUSUM.
TIGHT = Params(cusum_limit=3.0)
# Few sample entities average above 0.5, so the lowest band is opened down to 0.
EVERY_ENTITY = Params(severity_bands=(*SEVERITY_BANDS[:3], (0.0, "BAIXA")))

_CATALOGUE: dict[str, Query] = {}


def catalogue() -> dict[str, Query]:
    return dict(_CATALOGUE)


def _comparable(df: DataFrame) -> DataFrame:
    """Portable column types: doubles at 6 places, integers as long, dates and times as text."""

    def plain(name: str, kind: str) -> str:
        if kind == "double" or kind.startswith("decimal"):
            return f"round(cast({name} as double), 6) as {name}"
        if kind in ("int", "smallint", "tinyint"):
            return f"cast({name} as bigint) as {name}"
        if kind == "date":
            return f"cast({name} as string) as {name}"
        if kind.startswith("timestamp"):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as {name}"
        return name

    return df.selectExpr(*[plain(n, k) for n, k in df.dtypes])


def _query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _comparable(build(spark, folder))

    _CATALOGUE[build.__name__] = run
    return build


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean(sample_map.bronze(spark, folder))


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    """Clean transactions with their day: all that the detectors need of silver."""
    return silver.derive(_clean(spark, folder))


def _detector_input(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return _dated(spark, folder).select(
        "transacao_id", "associado_id", "agencia_id", "tipo", "valor", "dt_transacao", "dt", *more
    )


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    dims = sample_map.dimensions(spark, folder)
    return medallion.silver_plan(sample_map.bronze(spark, folder), dims, PARAMS)


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Silver without member and branch attributes, which gold does not use."""
    joined = _dated(spark, folder).join(
        F.broadcast(sample_map.dim_calendar(spark, folder).drop("dia_semana")), "dt", "left"
    )
    return silver.flag(joined, PARAMS)


# --- sources and sinks -------------------------------------------------------------------------


@_query
def bronze_scan(spark, folder):
    """Bronze over two drops, batch and stream, by the reader; its time range reaches the scans as a filter."""
    rows, paths = sample_map.bronze(spark, folder), [scratch_path(spark, n) for n in ("bronze", "drop")]
    old = F.col("dt_transacao") < F.lit("2024-01-20").cast("timestamp_ntz")
    tables.write_bronze(rows.where(old), paths[0])
    rows.where(~old).write.partitionBy("agencia_id").parquet(paths[1])
    return tables.read_bronze(spark, paths, since="2024-01-03").select(*TRANSACTION_COLUMNS)


@_query
def bronze_roundtrip(spark, folder):
    path = scratch_path(spark, "bronze")
    tables.write_bronze(sample_map.bronze(spark, folder), path)
    return tables.read_bronze(spark, path).select(*TRANSACTION_COLUMNS)


@_query
def silver_roundtrip(spark, folder):
    path = scratch_path(spark, "silver")
    tables.write_silver(_silver(spark, folder), path)
    return tables.read_table(spark, path).select(*_SILVER_SHOWN)


@_query
def gold_roundtrip(spark, folder):
    """All three facts written and read again, one row each per key: table, key, day or month, rows, sum."""
    root, tx = scratch_path(spark, "gold"), materialise(_flagged(spark, folder), "silver")
    parts = []
    for name, plan in medallion.gold_plans(tx).items():
        tables.write_table(plan, f"{root}/{name}")
        stored = tables.read_table(spark, f"{root}/{name}")
        key = next(c for c in ("operador_id", "associado_id", "agencia_id") if c in stored.columns)
        when = next(c for c in ("dt", "ano_mes") if c in stored.columns)
        branch = F.col("agencia_id") if "agencia_id" in stored.columns else F.lit(None).cast("string")
        parts.append(stored.select(F.lit(name).alias("tabela"), F.col(key).alias("chave"), branch.alias("agencia_id"),
                                   F.col(when).cast("string").alias("quando"), "qtd_tx", "valor_total"))
    return reduce(DataFrame.unionByName, parts)


@_query
def alerts_roundtrip(spark, folder):
    path = scratch_path(spark, "alerts")
    tables.write_alerts(sample_map.labelled_alerts(spark, folder), path)
    return tables.read_alerts(spark, path)


@_query
def stream_ingest(spark, folder):
    landing, output, checkpoint = (
        scratch_path(spark, n) for n in ("landing", "stream", "stream-checkpoint")
    )
    drops = sample_map.transactions(spark, folder).write
    drops.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(landing)
    start_ingestion(spark, landing, output, checkpoint, drain=True).awaitTermination()
    return tables.read_bronze(spark, output).select(*TRANSACTION_COLUMNS)


# --- silver ------------------------------------------------------------------------------------

_SILVER_SHOWN = [
    "transacao_id",
    "associado_id",
    "agencia_id",
    "valor",
    "dt",
    "hora",
    "dia_semana",
    "primeiro_digito",
    "segmento",
    "dt_adesao",
    "score_risco",
    "uf_residencia",
    "municipio",
    "uf",
    "porte",
    "ano",
    "mes",
    "dia_util",
    "feriado",
    "flag_fora_horario",
    "flag_fim_de_semana",
    "flag_valor_alto",
    "flag_alta_alcada",
]


@_query
def silver_clean(spark, folder):
    return _clean(spark, folder).select(*TRANSACTION_COLUMNS)


@_query
def silver_rejects(spark, folder):
    """Rows per reason, and what a run would do with them."""
    kept, rejected, counts = silver.split_rejects(sample_map.bronze(spark, folder), scratch_path(spark, "rejects"), 0.9)
    found = rejected.groupBy("motivo_rejeicao").agg(F.count(F.lit(1)).alias("qtd"), F.count_distinct("transacao_id").alias("ids"))
    clean = kept.agg(F.lit("OK").alias("motivo_rejeicao"), F.count(F.lit(1)).alias("qtd"), F.count_distinct("transacao_id").alias("ids"))
    return found.union(clean).withColumn("parte", F.col("qtd") / F.lit(counts["linhas"]))


@_query
def silver_derive(spark, folder):
    return _dated(spark, folder).select("transacao_id", "dt", "hora", "dia_semana", "primeiro_digito")


@_query
def first_digit(spark, folder):
    price = sample_map.sample_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        silver.first_digit(F.col("l_extendedprice")).alias("preco"),
        silver.first_digit(F.col("l_discount")).alias("desconto"),
    )
    return price


@_query
def silver_enrich(spark, folder):
    return _silver(spark, folder).select(*_SILVER_SHOWN)


@_query
def silver_flags(spark, folder):
    flags = ("flag_fora_horario", "flag_fim_de_semana", "flag_valor_alto", "flag_alta_alcada")
    return _flagged(spark, folder).select("transacao_id", *flags)


@_query
def dim_calendar(spark, folder):
    orders = sample_map.sample_table(spark, folder, "orders")
    return silver.calendar(orders.select(F.to_date("o_orderdate").alias("dt")))


# --- gold --------------------------------------------------------------------------------------


@_query
def gold_branch_day(spark, folder):
    return facts.branch_day(_flagged(spark, folder))


@_query
def gold_operator_day(spark, folder):
    return facts.operator_day(_flagged(spark, folder))


@_query
def gold_member_month(spark, folder):
    return facts.member_month(_dated(spark, folder))


def _late_lake(spark: SparkSession, folder: str) -> str:
    """A lake filled in three runs: most days, then two late days with copies of what is there, then copies only."""
    bronze, dims = sample_map.bronze(spark, folder), sample_map.dimensions(spark, folder)
    root = scratch_path(spark, "lake")
    late = F.dayofmonth("dt_transacao").isin(5, 17)
    again = F.col("tipo") == "DEPOSITO"
    for part in (bronze.where(~late), bronze.where(late | again), bronze.where(again)):
        incremental.refresh(spark, part, dims, root, PARAMS)
    return root


@_query
def gold_incremental(spark, folder):
    """The monthly fact after late days; equal to a rebuild."""
    return spark.read.parquet(f"{_late_lake(spark, folder)}/{incremental.MEMBER_MONTH}")


@_query
def gold_incremental_days(spark, folder):
    return tables.read_table(spark, f"{_late_lake(spark, folder)}/{incremental.BRANCH_DAY}")


@_query
def stream_to_silver(spark, folder):
    """Drops with copies and late files, taken in by several micro-batches; equal to the batch run."""
    landing, root, checkpoint = (scratch_path(spark, n) for n in ("landing", "lake", "silver-checkpoint"))
    rows = sample_map.bronze(spark, folder)
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    late = F.dayofmonth("dt_transacao") == 5
    for part in (rows.where(~late), rows.where(late | (F.col("canal") == "ATM"))):
        part.repartition(4).write.mode("append").option("timestampNTZFormat", form).json(landing)
        dims = sample_map.dimensions(spark, folder)
        incremental.start_silver_stream(
            spark, landing, dims, root, checkpoint, PARAMS, drain=True, files_per_trigger=2
        ).awaitTermination()
    return tables.read_table(spark, f"{root}/{incremental.SILVER}").select(*_SILVER_SHOWN)


# --- statistical detectors ---------------------------------------------------------------------


@_query
def cusum_series(spark, folder):
    volume = control_charts.branch_volume(_dated(spark, folder))
    return control_charts.cusum_series(volume, "agencia_id", "dt", "qtd_tx", TIGHT)


@_query
def d1_cusum(spark, folder):
    return control_charts.cusum_by_branch(_dated(spark, folder), PARAMS)


@_query
def cusum_orders_by_nation(spark, folder):
    orders, customer = (sample_map.sample_table(spark, folder, t) for t in ("orders", "customer"))
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    daily = placed.groupBy(
        F.col("c_nationkey").cast("string").alias("nacao"), F.to_date("o_orderdate").alias("dt")
    ).agg(F.count(F.lit(1)).alias("qtd_tx"))
    return control_charts.cusum(daily, "nacao", "dt", "qtd_tx", PARAMS)


@_query
def ewma_series(spark, folder):
    ticket = control_charts.pix_ticket(_dated(spark, folder))
    return control_charts.ewma_series(ticket, "associado_id", "dt", "ticket_medio", PARAMS)


@_query
def d2_ewma(spark, folder):
    return control_charts.ewma_by_member(_dated(spark, folder), PARAMS)


@_query
def ewma_orders_by_customer(spark, folder):
    orders = sample_map.sample_table(spark, folder, "orders")
    daily = orders.groupBy(
        F.col("o_custkey").alias("cliente"), F.to_date("o_orderdate").alias("dt")
    ).agg(F.avg("o_totalprice").alias("ticket_medio"))
    return control_charts.ewma(daily, "cliente", "dt", "ticket_medio", PARAMS)


@_query
def d3_hourly(spark, folder):
    return control_charts.hourly_limits(_clean(spark, folder), PARAMS)


@_query
def benford_histogram(spark, folder):
    return benford.digit_histogram(_clean(spark, folder), "tipo")


@_query
def d4_benford(spark, folder):
    return benford.benford_by_segment(_clean(spark, folder), PARAMS)


@_query
def d4_benford_cube(spark, folder):
    tx = _clean(spark, folder).withColumn("ano_mes", F.date_format("dt_transacao", "yyyy-MM"))
    return benford.benford_cube(tx, PARAMS)


@_query
def benford_lineitem_by_flag(spark, folder):
    lines = sample_map.sample_table(spark, folder, "lineitem")
    return benford.benford_by_segment(lines, PARAMS, "l_returnflag", "l_extendedprice")


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The detector columns as a stored table, for operators that read their input repeatedly."""
    return materialise(_detector_input(spark, folder), "silver")


@_query
def structuring_windows(spark, folder):
    return pld.structuring_windows(_stored(spark, folder), PARAMS)


@_query
def structuring_sliced(spark, folder):
    return pld.structuring_windows(_stored(spark, folder), replace(PARAMS, slice_seconds=60))


@_query
def d5_structuring(spark, folder):
    return pld.structuring(_stored(spark, folder), PARAMS)


# --- learned detectors -------------------------------------------------------------------------


def _model_input(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return _dated(spark, folder).select(
        "transacao_id", "associado_id", "valor", "dt_transacao", "conta_destino", "geo_lat", "geo_lon", *more
    )


def _joined(spark: SparkSession, folder: str, tx: DataFrame) -> DataFrame:
    members = sample_map.dim_member(spark, folder).select("associado_id", "dt_adesao", "score_risco")
    return materialise(tx.join(members, "associado_id", "left"), "silver")


def _with_members(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return _joined(spark, folder, _model_input(spark, folder, *more))


def _feature_table(spark: SparkSession, folder: str) -> DataFrame:
    matrix = features.member_features(_with_members(spark, folder), PARAMS)
    return materialise(matrix, "features")


@_query
def m1_features(spark, folder):
    return features.member_features(_with_members(spark, folder), PARAMS)


@_query
def m1_features_sliced(spark, folder):
    return features.member_features(_with_members(spark, folder), replace(PARAMS, slice_seconds=60))


@_query
def m1_forest_train(spark, folder):
    return forest.grow_forest(_feature_table(spark, folder))


@_query
def m1_forest_score(spark, folder):
    matrix = _feature_table(spark, folder)
    nodes = forest.grow_forest(matrix)
    raw = materialise(forest.forest_scores(matrix, nodes), "forest-scores")
    return forest.normalise(raw)


@_query
def m1_forest_score_stored(spark, folder):
    """Scores from the stored node table alone."""
    matrix = _feature_table(spark, folder)
    path = scratch_path(spark, "models")
    save_models(spark, medallion.Models(forest_nodes=forest.grow_forest(matrix)), path)
    raw = forest.forest_scores(matrix, load_models(spark, path).forest_nodes)
    return forest.normalise(materialise(raw, "forest-scores"))


@_query
def m1_by_channel(spark, folder):
    matrix = features.member_features(_with_members(spark, folder, "canal"), PARAMS, ("canal",))
    matrix = materialise(matrix, "features")
    nodes = forest.grow_forest(matrix, trees=50, group="canal")
    return forest.normalise(materialise(forest.forest_scores(matrix, nodes, group="canal"), "forest-scores"))


@_query
def m1_normalise(spark, folder):
    raw = sample_map.sample_table(spark, folder, "events").select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("transacao_id"),
        (F.col("value") / (F.col("value") + 50.0)).alias("bruto"),
    )
    return forest.normalise(materialise(raw, "forest-scores"))


@_query
def m2_profile(spark, folder):
    return facts.member_profile(_clean(spark, folder), PARAMS)


@_query
def m2_autoencoder_score(spark, folder):
    profile = materialise(facts.member_profile(_clean(spark, folder), PARAMS), "profiles")
    return ae.autoencoder_findings(profile, ae.train_autoencoder(profile))


@_query
def m2_score_stored(spark, folder):
    """Scores from a stored weight table; the weights are those training starts from."""
    profile = materialise(facts.member_profile(_clean(spark, folder), PARAMS), "profiles")
    path = scratch_path(spark, "models")
    save_models(spark, medallion.Models(autoencoder=ae.train_autoencoder(profile, epochs=0)), path)
    return ae.autoencoder_findings(profile, load_models(spark, path).autoencoder)


@_query
def m2_training_metrics(spark, folder):
    profile = materialise(facts.member_profile(_clean(spark, folder), PARAMS), "profiles")
    return medallion.model_metrics(spark, medallion.Models(autoencoder=ae.train_autoencoder(profile)))


@_query
def model_tables_roundtrip(spark, folder):
    """Rows scored, and rows whose score changes when the models come from their stored tables."""
    # Features and profiles come from one stored cleaning.
    tx = materialise(_model_input(spark, folder, "canal"), "clean")
    matrix = materialise(features.member_features(_joined(spark, folder, tx.drop("canal")), PARAMS), "features")
    profile = materialise(facts.member_profile(tx, PARAMS), "profiles")
    network = ae.train_autoencoder(profile, epochs=5)
    fitted = medallion.Models(materialise(forest.grow_forest(matrix, trees=20), "forest"), network)
    path = scratch_path(spark, "models")
    save_models(spark, fitted, path)
    loaded = load_models(spark, path)
    differ = F.count_if(~F.col("antes").eqNullSafe(F.col("depois"))).alias("diferentes")

    def compared(name: str, before: DataFrame, after: DataFrame, keys: list[str], score: str) -> DataFrame:
        sides = [d.select(*keys, F.col(score).alias(c)) for d, c in ((before, "antes"), (after, "depois"))]
        both = sides[0].join(sides[1], keys, "full")
        return both.agg(F.count(F.lit(1)).alias("linhas"), differ).select(F.lit(name).alias("modelo"), "linhas", "diferentes")

    trees = [forest.forest_scores(matrix, m.forest_nodes) for m in (fitted, loaded)]
    nets = [ae.reconstruction_error(profile, m.autoencoder) for m in (fitted, loaded)]
    return compared("isolation_forest", *trees, ["transacao_id"], "bruto").union(
        compared("autoencoder", *nets, ["associado_id", "ano_mes"], "erro")
    )


@_query
def m2_threshold(spark, folder):
    profile = facts.member_profile(_clean(spark, folder), PARAMS)
    errors = profile.select(
        "associado_id", "ano_mes", (F.col("valor_max") / F.col("valor_total")).alias("erro")
    )
    errors = materialise(errors, "errors")
    top = exact_quantiles(errors, "erro", [0.99]).first()
    return ae.error_findings(errors, top["quantil"])


@_query
def m3_training_set(spark, folder):
    alerts = sample_map.labelled_alerts(spark, folder)
    return calibrator.training_set(alerts, sample_map.labelled_scores(spark, folder))


@_query
def m3_calibrated(spark, folder):
    alerts = sample_map.labelled_alerts(spark, folder)
    labelled = materialise(
        calibrator.training_set(alerts, sample_map.labelled_scores(spark, folder)), "labelled"
    )
    fitted = calibrator.train_calibrator(labelled)
    judged = calibrator.apply_calibrator(fitted, labelled)
    return judged.select("alerta_id", "confirmado", "prob_confirmacao")


# --- scores and alerts -------------------------------------------------------------------------


def _score_findings(spark: SparkSession, folder: str) -> DataFrame:
    """The seven labelled detector scores in the shape of detector findings."""
    alert = F.col("score") > 0.9
    pld_rule = F.col("regra_id") == "D5_FRACIONAMENTO"
    return sample_map.labelled_scores(spark, folder).select(
        F.concat(F.lit("T"), F.substring("alerta_id", 2, 20)).alias("transacao_id"),
        "regra_id",
        F.when(pld_rule, F.lit("PLD")).otherwise(F.lit("FRAUDE")).alias("familia"),
        alert.alias("alerta"),
        "score",
        F.when(alert, F.concat(F.lit("Sinal de "), F.col("regra_id"))).alias("motivo"),
    )


@_query
def severity_bins(spark, folder):
    scored = sample_map.sample_table(spark, folder, "events").select(
        "event_id", F.least(F.lit(1.0), F.col("value") / 150.0).alias("score")
    )
    return scored.withColumn("severidade", severity(F.col("score"), PARAMS))


@_query
def combine_scores(spark, folder):
    return scoring.combine_scores(spark, [_score_findings(spark, folder)], PARAMS)


@_query
def alerts_table(spark, folder):
    combined = scoring.combine_scores(spark, [_score_findings(spark, folder)], PARAMS)
    return scoring.build_alerts(combined, RUN_AT)


@_query
def full_scoring(spark, folder):
    return medallion.alerts_plan(_stored(spark, folder), RUN_AT, EVERY_ENTITY)


def _stored_models(spark: SparkSession, tx: DataFrame) -> medallion.Models:
    """Models fitted on `tx`, written and read again; the network keeps the weights that training starts from."""
    path = scratch_path(spark, "models")
    save_models(spark, medallion.train_models(tx, PARAMS, epochs=0), path)
    return load_models(spark, path)


@_query
def full_scoring_models(spark, folder):
    """The whole run, rules D1 to D5 and stored models M1 and M2, at the regular severity bands."""
    tx = _with_members(spark, folder, "canal", "agencia_id", "tipo", "dt")
    return medallion.alerts_plan(tx, RUN_AT, PARAMS, _stored_models(spark, tx))


@_query
def alert_transactions(spark, folder):
    tx = materialise(_detector_input(spark, folder, "canal"), "silver")
    found = medallion.statistical_findings(tx, PARAMS)
    combined = scoring.combine_scores(spark, found, EVERY_ENTITY)
    alerts = scoring.build_alerts(combined, RUN_AT)
    return evidence.alert_transactions(alerts, evidence.evidence(found, PARAMS), tx, PARAMS)


@_query
def feedback_latest(spark, folder):
    return feedback.latest_verdicts(sample_map.feedback(spark, folder))


@_query
def alert_queue_calibrated(spark, folder):
    alerts = sample_map.labelled_alerts(spark, folder).withColumn("status", F.lit("ABERTO"))
    scores, verdicts = sample_map.labelled_scores(spark, folder), sample_map.feedback(spark, folder)
    fitted = calibrator.train_calibrator(feedback.labelled(alerts, scores, verdicts))
    return feedback.calibrated_queue(alerts, scores, verdicts, _clean(spark, folder), fitted)


@_query
def severity_distribution(spark, folder):
    combined = scoring.combine_scores(spark, [_score_findings(spark, folder)], PARAMS)
    return scoring.severity_distribution(scoring.build_alerts(combined, RUN_AT))


# --- cockpit and evaluation --------------------------------------------------------------------


@_query
def kpi_summary(spark, folder):
    return cockpit.kpi_summary(sample_map.labelled_alerts(spark, folder), AS_OF)


@_query
def alerts_by_family_month(spark, folder):
    return cockpit.alerts_by_family_month(sample_map.labelled_alerts(spark, folder))


@_query
def top_branches(spark, folder):
    tx = _stored(spark, folder)
    volume = control_charts.branch_volume(tx)
    return cockpit.top_branches(sample_map.labelled_alerts(spark, folder), tx, volume)


@_query
def alerts_by_city(spark, folder):
    return cockpit.alerts_by_city(
        sample_map.labelled_alerts(spark, folder),
        _clean(spark, folder),
        sample_map.dim_branch(spark, folder),
    )


def _engine_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The engine's own alert table: alerts on branches, members and everything."""
    return materialise(_CATALOGUE["full_scoring"](spark, folder), "engine-alerts")


@_query
def top_branches_engine(spark, folder):
    tx = _stored(spark, folder)
    return cockpit.top_branches(_engine_alerts(spark, folder), tx, control_charts.branch_volume(tx))


@_query
def alerts_by_city_engine(spark, folder):
    branches = sample_map.dim_branch(spark, folder)
    return cockpit.alerts_by_city(_engine_alerts(spark, folder), _clean(spark, folder), branches)


@_query
def alert_drillthrough(spark, folder):
    branches = sample_map.dim_branch(spark, folder)
    detail = _clean(spark, folder).join(branches, "agencia_id", "left")
    critical = F.col("severidade").isin("BAIXA", "CRITICA")
    return cockpit.alert_drillthrough(sample_map.labelled_alerts(spark, folder), detail, critical)


@_query
def star_branch_day(spark, folder):
    dims = sample_map.dimensions(spark, folder)
    return cockpit.star_branch_day(facts.branch_day(_flagged(spark, folder)), dims.branches, dims.days)


@_query
def star_operator_day(spark, folder):
    return cockpit.star_operator_day(
        facts.operator_day(_flagged(spark, folder)),
        sample_map.dim_operator(spark, folder),
        sample_map.dim_calendar(spark, folder),
    )


@_query
def score_histogram(spark, folder):
    return cockpit.score_histogram(sample_map.labelled_alerts(spark, folder))


@_query
def confusion_matrix(spark, folder):
    return cockpit.confusion_matrix(sample_map.labelled_alerts(spark, folder))


@_query
def fp_rate_by_rule(spark, folder):
    return cockpit.fp_rate_by_rule(sample_map.labelled_alerts(spark, folder))


@_query
def psi_by_week(spark, folder):
    alerts = sample_map.labelled_alerts(spark, folder)
    week = F.date_trunc("week", "dt_alerta").cast("date")
    return evaluation.psi_by_period(
        alerts, "score", week, F.to_date("dt_alerta") < F.lit("2024-01-08").cast("date")
    )


@_query
def psi_features(spark, folder):
    """Drift of all eleven features by week against a stored baseline of the first week."""
    matrix = features.member_features(_with_members(spark, folder, "dt"), PARAMS, ("dt",))
    matrix = materialise(matrix, "features")
    first = matrix.where(F.col("dt") < F.lit("2024-01-08").cast("date"))
    baseline = materialise(evaluation.feature_baseline(first, features.FEATURE_COLUMNS), "baseline")
    week = F.date_trunc("week", "dt").cast("date")
    return evaluation.feature_drift(matrix, baseline, week, features.FEATURE_COLUMNS)


def _scored_truth(spark: SparkSession, folder: str) -> DataFrame:
    scores = sample_map.labelled_alerts(spark, folder).select("transacao_id", "score")
    truth = _clean(spark, folder).select("transacao_id", "fraude_label", "fraude_tipo")
    return truth.join(scores, "transacao_id")


@_query
def precision_at_k(spark, folder):
    return evaluation.precision_at_k(_scored_truth(spark, folder), 100)


@_query
def recall_by_type(spark, folder):
    return evaluation.recall_by_type(_scored_truth(spark, folder), 0.5)
