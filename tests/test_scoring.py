"""Combination of findings, alerts and cockpit arithmetic on tiny frames."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from txwatch.operators import scoring
from txwatch.params import Params
from txwatch.plans import cockpit, evaluation
from txwatch.sources.schemas import ALERTS

PARAMS = Params()


def findings(spark, rows, key="transacao_id"):
    schema = f"{key} string, regra_id string, familia string, alerta boolean, score double, motivo string"
    return spark.createDataFrame(rows, schema)


def test_weighted_combination(spark):
    first = findings(
        spark,
        [
            ("t1", "M1_ISOLATION_FOREST", "FRAUDE", True, 1.0, "m1"),
            ("t2", "M1_ISOLATION_FOREST", "FRAUDE", True, 0.8, None),
        ],
    )
    second = findings(spark, [("t1", "D5_FRACIONAMENTO", "PLD", True, 0.9, "d5")])
    rows = {r["entidade"]: r for r in scoring.combine_scores(spark, [first, None, second], PARAMS).collect()}
    assert rows["t1"]["score"] == pytest.approx((0.25 + 0.9 * 0.2) / 0.45)
    assert rows["t1"]["severidade"] == "CRITICA" and rows["t2"]["severidade"] == "MEDIA"
    assert rows["t1"]["regras"] == "D5_FRACIONAMENTO|M1_ISOLATION_FOREST"
    assert rows["t1"]["familias"] == "FRAUDE|PLD" and rows["t1"]["familia"] == "FRAUDE"
    assert rows["t1"]["motivos"] == "d5 | m1" and rows["t2"]["motivos"] == ""


def test_every_finding_counts_and_missing_scores_are_zero(spark):
    quiet = [("AG1", "D1_CUSUM", "FRAUDE", False, 0.2, None)] * 3
    odd = [
        ("AG1", "D1_CUSUM", "FRAUDE", True, 1.0, "x"),
        ("AG2", "D3_3SIGMA_HORA", "CONTROLE_INTERNO", False, float("nan"), None),
        ("AG2", "D3_3SIGMA_HORA", "CONTROLE_INTERNO", False, None, None),
        ("AG2", "D3_3SIGMA_HORA", "CONTROLE_INTERNO", True, 1.0, "y"),
        ("AG3", "UNKNOWN", "FRAUDE", True, 1.0, "z"),
    ]
    every = Params(severity_bands=((0.0, "BAIXA"),))
    got = scoring.combine_scores(spark, [findings(spark, quiet + odd, "agencia_id")], every)
    scores = {r["entidade"]: r["score"] for r in got.collect()}
    assert scores["AG1"] == pytest.approx(0.4) and scores["AG2"] == pytest.approx(1 / 3)
    assert scores["AG3"] == 0.0


def test_entity_falls_back_and_empty_input_is_typed(spark):
    member = findings(spark, [("A", "D2_EWMA", "FRAUDE", True, 1.0, "m")], "associado_id")
    keyless = findings(spark, [("TED", "D4_BENFORD", "FRAUDE", True, 1.0, "b")], "chave")
    got = scoring.combine_scores(spark, [member, keyless], PARAMS)
    assert sorted(r["entidade"] for r in got.collect()) == ["-", "A"]
    nothing = scoring.build_alerts(scoring.combine_scores(spark, [None], PARAMS), "2026-01-01")
    assert nothing.count() == 0 and nothing.schema.fieldNames() == ALERTS.fieldNames()


def test_empty_weights_mean_the_defaults(spark):
    row = findings(spark, [("t", "D5_FRACIONAMENTO", "PLD", True, 0.9, None)])
    got = scoring.combine_scores(spark, [row], Params(weights={})).first()
    assert got["score"] == pytest.approx(0.9) and got["peso_total"] == pytest.approx(0.2)


def test_alert_ids_repeat(spark):
    combined = scoring.combine_scores(
        spark, [findings(spark, [("t", "D5_FRACIONAMENTO", "PLD", True, 0.9, "m")])], PARAMS
    )
    a, b = (scoring.build_alerts(combined, d).first() for d in ("2026-01-01", "2026-02-01"))
    assert a["alerta_id"] == b["alerta_id"] and a["dt_alerta"] != b["dt_alerta"]
    assert a["status"] == "ABERTO" and a["severidade"] == "ALTA"


def alerts(spark, rows):
    return spark.createDataFrame(
        [(f"a{i}", t, dt.datetime(2026, 1, d), rule, "FRAUDE", sev, s, "m", st)
         for i, (t, d, rule, sev, s, st) in enumerate(rows)],
        ALERTS,
    )


def test_cockpit_measures(spark):
    table = alerts(
        spark,
        [
            ("t1", 1, "D1_CUSUM|D2_EWMA", "CRITICA", 1.0, "CONFIRMADO"),
            ("t2", 3, "D1_CUSUM", "BAIXA", 0.5, "FALSO_POSITIVO"),
            ("t3", 5, "D2_EWMA", "CRITICA", 0.96, "ABERTO"),
            ("AG9", 5, "D1_CUSUM", "ALTA", 0.9, "ABERTO"),
            ("t4", 5, "D2_EWMA", "MEDIA", 0.7, None),
        ],
    )
    kpi = cockpit.kpi_summary(table, "2026-01-11").first()
    assert (kpi["alertas_abertos"], kpi["alertas_criticos"]) == (2, 2)
    assert kpi["pct_falso_positivo"] == pytest.approx(0.25) and kpi["dias_tratamento"] == 9.0
    rates = {r["regra"]: r["taxa_fp"] for r in cockpit.fp_rate_by_rule(table).collect()}
    assert rates == {"D1_CUSUM": 0.5, "D2_EWMA": 0.0}
    tx = spark.createDataFrame([("t3", "AG1"), ("t1", "AG1")], "transacao_id string, agencia_id string")
    volume = spark.createDataFrame([("AG1", 500), ("AG1", 500), ("AG9", 100)], "agencia_id string, qtd_tx bigint")
    top = cockpit.top_branches(table, tx, volume, k=1).collect()
    assert [(r["agencia_id"], r["alertas_por_mil"]) for r in top] == [("AG9", 10.0)]
    member = table.where("transacao_id = 't3'").withColumn("transacao_id", F.lit("AS1"))
    top = cockpit.top_branches(table.unionByName(member), tx, volume, k=1).collect()
    assert [(r["agencia_id"], r["alertas_abertos"]) for r in top] == [("AG9", 1), (None, 1)]
    plan = cockpit.alert_branch(table, tx, volume)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("Inner")
    cells = {(r["status"], r["acima"]): r["qtd"] for r in cockpit.confusion_matrix(table).collect()}
    assert cells[("ABERTO", True)] == 2 and cells[("FALSO_POSITIVO", False)] == 1
    empty = cockpit.kpi_summary(table.limit(0), "2026-01-11").first()
    assert empty["alertas_abertos"] == 0 and empty["pct_falso_positivo"] is None


def test_score_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.049,), (0.05,), (1.0,), (None,)], "score double")
    bins = {r["faixa"]: r["qtd"] for r in cockpit.score_histogram(df).collect()}
    assert bins == {0: 2, 1: 1, 19: 1}


def test_psi_is_zero_on_the_baseline_and_grows_with_drift(spark):
    base = [(0, float(i)) for i in range(100)]
    same = [(1, float(i)) for i in range(100)]
    moved = [(2, float(i) + 300) for i in range(100)]
    df = spark.createDataFrame(base + same + moved, "w int, v double")
    psi = {r["periodo"]: r["psi"] for r in
           evaluation.psi_by_period(df, "v", F.col("w"), F.col("w") == 0).collect()}
    assert psi[0] == 0.0 and psi[1] == pytest.approx(0.0)
    want = 9 * (1e-4 - 0.1) * math.log(1e-4 / 0.1) + 0.9 * math.log(10)
    assert psi[2] == pytest.approx(want)


def test_precision_and_recall(spark):
    rows = [("a", 0.9, True, "F1"), ("b", 0.8, False, None), ("c", 0.7, True, "F2"),
            ("d", 0.1, True, "F2"), ("e", None, True, "F1")]
    df = spark.createDataFrame(rows, "transacao_id string, score double, fraude_label boolean, fraude_tipo string")
    best = evaluation.precision_at_k(df, 3).first()
    assert (best["k"], best["acertos"]) == (3, 2)
    recall = {r["fraude_tipo"]: r["recall"] for r in evaluation.recall_by_type(df, 0.5).collect()}
    assert recall == {"F1": 0.5, "F2": 0.5}
