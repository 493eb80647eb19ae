"""Verdicts, the calibrated queue and the transactions behind alerts."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from txwatch.operators import calibrator, evidence, feedback, scoring
from txwatch.params import Params
from txwatch.plans import catalogue, medallion
from txwatch.session import materialise
from txwatch.sources import sample_map

DAY = dt.datetime(2026, 3, 10)
VERDICTS = "feedback_id long, alerta_id string, auditor string, veredito string, dt_veredito timestamp_ntz"


def test_last_verdict_wins(spark):
    later = DAY + dt.timedelta(hours=1)
    rows = [
        (1, "a", "x", "CONFIRMADO", DAY), (2, "a", "y", "FALSO_POSITIVO", later), (3, "b", "x", "CONFIRMADO", None),
        (4, "b", "x", "EM_ANALISE", DAY), (6, "c", "x", "CONFIRMADO", DAY), (5, "c", "x", "FALSO_POSITIVO", DAY),
        (7, "d", "x", "maybe", DAY), (8, None, "x", "CONFIRMADO", DAY), (9, "e", None, "ABERTO", DAY), (9, "e", None, "ABERTO", DAY),
        (None, "f", "x", "CONFIRMADO", DAY), (1, "f", "x", "FALSO_POSITIVO", DAY),
    ]
    df = spark.createDataFrame(rows, VERDICTS).withColumn("u", F.lit("clash"))
    found = {r["alerta_id"]: (r["status"], r["vereditos"]) for r in feedback.latest_verdicts(df.repartition(5)).collect()}
    assert found == {
        "a": ("FALSO_POSITIVO", 2), "b": ("EM_ANALISE", 2), "c": ("CONFIRMADO", 2), "e": ("ABERTO", 2), "f": ("FALSO_POSITIVO", 2)}
    assert feedback.latest_verdicts(df.limit(0)).count() == 0


def test_queue_follows_verdicts_and_probability(spark):
    names = "alerta_id string, transacao_id string, dt_alerta timestamp_ntz, regra_id string, familia string, severidade string, score double, status string"
    alerts = spark.createDataFrame(
        [(f"a{i}", f"t{i}" if i % 3 else None, DAY, "D1_CUSUM", "FRAUDE", "ALTA", i / 300, "ABERTO") for i in range(300)], names
    )
    scores = spark.createDataFrame([(f"a{i}", "M1_ISOLATION_FOREST", i / 300) for i in range(0, 299)], "alerta_id string, regra_id string, score double")
    said = [(i, f"a{i}", "x", "CONFIRMADO" if i > 150 else "FALSO_POSITIVO", DAY) for i in range(0, 300, 2)]
    said += [(1000, "a2", "x", "EM_ANALISE", DAY + dt.timedelta(days=1))]
    said = spark.createDataFrame(said, VERDICTS)
    tx = spark.createDataFrame([(f"t{i}", "APP") for i in range(200)], "transacao_id string, canal string")
    fitted = calibrator.train_calibrator(materialise(feedback.labelled(alerts, scores, said), "labelled"))
    queue = feedback.calibrated_queue(alerts, scores, said, tx, fitted).collect()
    assert len(queue) == 151 and {r["alerta_id"] for r in queue} == {f"a{i}" for i in range(1, 300, 2)} | {"a2"}
    by_id = {r["alerta_id"]: r for r in queue}
    assert by_id["a2"]["status"] == "EM_ANALISE" and by_id["a1"]["canal"] == "APP" and by_id["a3"]["canal"] is None
    assert by_id["a299"]["prob_confirmacao"] is not None and by_id["a5"]["ano_mes"] == "2026-03"
    known = [r["prob_confirmacao"] for r in queue]
    assert known == sorted(known, reverse=True) and known[0] > 0.9 and known[-1] < 0.2
    plain = feedback.calibrated_queue(alerts, scores, said.limit(0), tx, None).collect()
    assert len(plain) == 300 and plain[0]["alerta_id"] == "a299" and plain[0]["prob_confirmacao"] is None


@pytest.fixture(scope="module")
def engine(spark):
    tx = materialise(catalogue._detector_input(spark, SAMPLE, "canal"), "silver")
    found = medallion.statistical_findings(tx, Params())
    combined = scoring.combine_scores(spark, found, catalogue.EVERY_ENTITY)
    return tx, found, materialise(scoring.build_alerts(combined, catalogue.RUN_AT), "alerts")


def test_every_entity_leads_to_rows(engine):
    tx, found, alerts = engine
    rows = evidence.alert_transactions(alerts, evidence.evidence(found, Params()), tx, Params())
    reached = {r[0] for r in rows.select("alerta_id").distinct().collect()}
    assert reached == {r[0] for r in alerts.where("transacao_id <> '-'").select("alerta_id").collect()}
    assert rows.groupBy("alerta_id", "transacao_id").count().where("count > 1").isEmpty()


def test_no_nested_loop_and_day_in_the_key(engine):
    tx, found, alerts = engine
    rows = evidence.alert_transactions(alerts, evidence.evidence(found, Params()), tx, Params())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_dia" in plan


def test_spans_by_rule(spark):
    tx = spark.createDataFrame(
        [(f"t{h}", "m", "b", DAY + dt.timedelta(hours=h), "PIX_OUT" if h % 2 else "SAQUE", 100.0, "APP") for h in range(-30, 30)]
        + [("x", None, None, DAY, "PIX_OUT", 1.0, "APP"), ("y", "m", "b", DAY, None, None, None)],
        "transacao_id string, associado_id string, agencia_id string, dt_transacao timestamp_ntz, tipo string, valor double, canal string",
    ).withColumn("de", F.lit("clash"))

    def finding(schema, *rows):
        return spark.createDataFrame(list(rows), schema + ", regra_id string, familia string, alerta boolean, score double, motivo string")

    found = [
        finding("associado_id string, dt date", ("m", DAY.date(), "D2_EWMA", "F", True, 1.0, "")),
        finding("agencia_id string, dt date, hora int", ("b", DAY.date(), 5, "D3_3SIGMA_HORA", "C", True, 1.0, ""), ("b", DAY.date(), 5, "D3_3SIGMA_HORA", "C", True, 1.0, ""), ("b", DAY.date(), 7, "D3_3SIGMA_HORA", "C", False, 0.0, None)),
        finding("associado_id string, dt date", ("m", DAY.date(), "D5_FRACIONAMENTO", "P", True, 1.0, ""), (None, DAY.date(), "D5_FRACIONAMENTO", "P", True, 1.0, "")),
        finding("transacao_id string", ("t9", "M1_ISOLATION_FOREST", "F", True, 1.0, "")),
        finding("chave string", ("PIX", "D4_BENFORD", "F", True, 1.0, "")),
    ]
    alerts = spark.createDataFrame([("A", "m"), ("B", "b"), ("T", "t9"), ("A", "m"), ("D", "-"), ("N", None)], "alerta_id string, transacao_id string")
    rows = evidence.alert_transactions(alerts, evidence.evidence(found, Params()), tx, Params()).collect()
    got = {(r["alerta_id"], r["transacao_id"]): r["regras"] for r in rows}
    assert len(got) == len(rows)
    both = {("A", f"t{h}"): "D2_EWMA|D5_FRACIONAMENTO" for h in range(1, 24, 2)}
    before = {("A", f"t{h}"): "D5_FRACIONAMENTO" for h in range(-23, 0, 2)}
    assert got == both | before | {("B", "t5"): "D3_3SIGMA_HORA", ("T", "t9"): "M1_ISOLATION_FOREST"}
    assert evidence.alert_transactions(alerts.limit(0), evidence.evidence(found, Params()), tx, Params()).count() == 0


def test_feedback_of_the_sample_has_repeats(spark):
    counts = duckdb.sql(f"select count(*) from '{SAMPLE}/events.parquet'").fetchall()[0][0]
    found = feedback.latest_verdicts(sample_map.feedback(spark, SAMPLE))
    assert found.agg(F.sum("vereditos")).first()[0] == counts and not found.where("vereditos > 1").isEmpty()
