"""Cleaning, silver, gold, sinks, stream and the batch run."""

from __future__ import annotations

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from txwatch.operators import facts, silver
from txwatch.params import HOLIDAYS, Params
from txwatch.plans import medallion
from txwatch.session import materialise, scratch_path, scratch_root
from txwatch.sources import sample_map, tables
from txwatch.sources.schemas import ALERTS, TRANSACTION_COLUMNS
from txwatch.streaming.ingest import start_ingestion

from conftest import SAMPLE

PARAMS = Params()
NOON = dt.datetime(2026, 5, 4, 12)


def test_clean_keeps_one_usable_row_per_id(spark):
    rows = [
        ("t1", "PIX_OUT", 10.0, NOON),
        ("t2", "PIX_OUT", 0.0, NOON),
        ("t3", None, 5.0, NOON),
        (None, "TED", 5.0, NOON),
        ("t1", "PIX_OUT", 10.0, NOON),
        ("t4", "TED", 5.0, None),
    ]
    df = spark.createDataFrame(rows, "transacao_id string, tipo string, valor double, dt_transacao timestamp_ntz")
    assert sorted(r["transacao_id"] for r in silver.clean(df).collect()) == ["t1", "t3"]


def test_clean_prefers_the_first_ingested_copy(spark):
    rows = [("t", float(v), NOON, NOON + dt.timedelta(hours=v)) for v in (3, 1, 2)] * 2
    schema = "transacao_id string, valor double, dt_transacao timestamp_ntz, dt_ingestao timestamp_ntz"
    df = spark.createDataFrame(rows, schema).repartition(4)
    assert [r["valor"] for r in silver.clean(df).collect()] == [1.0]


def test_copies_are_reduced_before_the_shuffle(spark):
    plan = silver.clean(sample_map.bronze(spark, SAMPLE))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_calendar(spark):
    days = spark.createDataFrame([(dt.date(2026, 4, 18),), (dt.date(2026, 9, 8),), (None,)], "dt date")
    rows = silver.calendar(days).orderBy("dt").collect()
    assert len(rows) == 144 and rows[0]["dia_semana"] == 5
    for r in rows:
        holiday = (r["dt"].month, r["dt"].day) in HOLIDAYS
        assert r["dia_semana"] == r["dt"].weekday()
        assert r["feriado"] == holiday
        assert r["dia_util"] == (r["dt"].weekday() < 5 and not holiday)
    assert silver.calendar(days.where("dt is null")).count() == 0


def test_flags(spark):
    rows = [
        (5, True, 60_000.0, "APP"),
        (6, False, 50_000.0, "APP"),
        (21, None, 100_000.01, "AGENCIA"),
        (22, True, 100_000.01, "APP"),
        (12, True, 100_000.01, None),
    ]
    df = spark.createDataFrame(rows, "hora int, dia_util boolean, valor double, canal string")
    got = [
        tuple(r[c] for c in ("flag_fora_horario", "flag_fim_de_semana", "flag_valor_alto", "flag_alta_alcada"))
        for r in silver.flag(df, PARAMS).collect()
    ]
    assert got == [
        (True, False, True, False),
        (False, True, False, False),
        (False, False, True, False),
        (True, False, True, True),
        (False, False, True, None),
    ]


def test_profile_fills_undefined_statistics(spark):
    rows = [("A", NOON, 10.0, None, "APP")]
    schema = "associado_id string, dt_transacao timestamp_ntz, valor double, conta_destino string, canal string"
    row = facts.member_profile(spark.createDataFrame(rows, schema), PARAMS).first()
    assert (row["valor_std"], row["destinos_unicos"], row["canais"], row["ano_mes"]) == (0.0, 0, 1, "2026-05")


@pytest.fixture(scope="module")
def bronze(spark):
    return materialise(sample_map.bronze(spark, SAMPLE), "bronze")


def test_bronze_reader_prunes_by_date_and_unites_paths(spark, bronze, tmp_path):
    path = str(tmp_path / "bronze")
    tables.write_bronze(bronze, path)
    back = tables.read_bronze(spark, path)
    assert sorted(back.columns) == sorted(TRANSACTION_COLUMNS)
    assert back.count() == bronze.count()
    some = tables.read_bronze(spark, path, since="2024-01-05", until="2024-01-06")
    want = bronze.where("to_date(dt_transacao) between date'2024-01-05' and date'2024-01-06'")
    assert some.count() == want.count() > 0
    assert "dt_partition" in some._jdf.queryExecution().toString().split("PartitionFilters")[1][:200]
    assert tables.read_bronze(spark, [path, path]).count() == 2 * bronze.count()


def test_branch_codes_stay_text(spark, tmp_path):
    path = str(tmp_path / "coded")
    df = spark.createDataFrame([("0017", NOON, "t")], "agencia_id string, dt_transacao timestamp_ntz, transacao_id string")
    tables.write_bronze(df, path)
    assert tables.read_bronze(spark, path).first()["agencia_id"] == "0017"


def test_stream_equals_batch_and_resumes(spark, bronze, tmp_path):
    landing, output, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    good = bronze.where("transacao_id is not null")
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    halves = [good.where("valor < 5000"), good.where("valor >= 5000")]
    for half in halves:
        half.repartition(12).write.mode("append").option("timestampNTZFormat", form).json(landing)
        start_ingestion(spark, landing, output, checkpoint, drain=True, files_per_trigger=5).awaitTermination()
    start_ingestion(spark, landing, output, checkpoint, drain=True).awaitTermination()
    got = tables.read_bronze(spark, output).select(*TRANSACTION_COLUMNS)
    want = good.select(*TRANSACTION_COLUMNS)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    landed = spark.read.json(landing).schema.fieldNames()
    assert "agencia_id" in landed


def test_alert_reader_casts_and_unites(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts = sample_map.labelled_alerts(spark, SAMPLE)
    tables.write_alerts(alerts, path)
    tables.write_alerts(alerts, path)  # overwrite, not append
    back = tables.read_alerts(spark, path)
    assert back.schema == ALERTS and back.count() == alerts.count()


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_scratch_without_the_setting(master):
    known = {"spark.sql.warehouse.dir": "/shared/warehouse"}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: known.get(name, default)),
        sparkContext=SimpleNamespace(master=master, applicationId="local-test"),
    )
    assert scratch_root(session) == "/shared/warehouse/_scratch"
    known["spark.checkpoint.dir"] = "/shared/checkpoints"
    assert scratch_root(session) == "/shared/checkpoints"


def test_batch_run_with_models(spark, bronze, tmp_path):
    dims = sample_map.dimensions(spark, SAMPLE)
    root = str(tmp_path / "lake")
    run_at = "2024-02-01 08:00:00"
    paths = medallion.run_batch(spark, bronze, dims, root, run_at)
    stored = tables.read_table(spark, paths["silver"])
    assert stored.count() == 1000
    assert tables.read_table(spark, paths["fato_agencia_dia"]).agg(F.sum("qtd_tx")).first()[0] == 1000

    models = medallion.train_models(stored, PARAMS)
    again = medallion.run_batch(spark, bronze, dims, root, run_at, PARAMS, models)
    alerts = tables.read_alerts(spark, again["alertas_auditoria"])
    rows = alerts.collect()
    assert rows and len({r["alerta_id"] for r in rows}) == len(rows)
    assert {r["status"] for r in rows} == {"ABERTO"}
    assert {r["severidade"] for r in rows} <= {"BAIXA", "MEDIA", "ALTA", "CRITICA"}
    assert any("M1_ISOLATION_FOREST" in r["regra_id"] for r in rows)
    assert all(0.5 <= r["score"] <= 1 for r in rows)
    metrics = medallion.model_metrics(spark, models).collect()
    assert json.dumps([r["metrica"] for r in metrics]).count("train_loss") == 8
    report = medallion.severity_report(alerts).collect()
    assert sum(r["qtd"] for r in report) == len(rows)
