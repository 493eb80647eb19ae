"""Incremental silver and gold, the silver stream, rejects, cubes, drift and the model store."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from txwatch.operators import autoencoder as ae
from txwatch.operators import benford, calibrator, facts, silver
from txwatch.operators.features import FEATURE_COLUMNS
from txwatch.params import Params
from txwatch.plans import evaluation, incremental, medallion
from txwatch.session import materialise
from txwatch.sources import model_store, sample_map, tables

PARAMS = Params()
FACTS = {incremental.BRANCH_DAY: facts.branch_day, incremental.OPERATOR_DAY: facts.operator_day, incremental.MEMBER_MONTH: facts.member_month}


@pytest.fixture(scope="module")
def raw(spark):
    rows = sample_map.bronze(spark, SAMPLE).where("dayofmonth(dt_transacao) < 8 and hash(transacao_id) % 4 = 0")
    # A month boundary, rows without a member and without a payee.
    moved = rows.where("dayofmonth(dt_transacao) = 2").selectExpr(
        "* except (transacao_id, dt_transacao, associado_id)", "concat('M', transacao_id) as transacao_id",
        "dt_transacao + interval 31 day as dt_transacao", "cast(null as string) as associado_id")
    return materialise(rows.unionByName(moved), "raw")


@pytest.fixture(scope="module")
def dims(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-01')) as dt")
    return medallion.Dimensions(sample_map.dim_member(spark, SAMPLE), sample_map.dim_branch(spark, SAMPLE), silver.calendar(days))


def same(left, right):
    columns = sorted(left.columns)
    plain = [F.round(c, 6).alias(c) if dict(left.dtypes)[c] == "double" else F.col(c).cast("string").alias(c) for c in columns]
    left, right = left.select(*plain), right.select(*plain)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def rebuilt(spark, root, raw, dims):
    want = materialise(medallion.silver_plan(raw, dims, PARAMS), "want")
    stored = tables.read_table(spark, f"{root}/{incremental.SILVER}")
    assert same(stored.select(*want.columns), want)
    for name, plan in FACTS.items():
        fact = tables.read_table(spark, f"{root}/{name}")
        assert same(fact.select(*plan(want).columns), plan(want)), name


def test_late_days_and_replays_equal_a_rebuild(spark, raw, dims, tmp_path):
    root = str(tmp_path / "lake")
    late = F.dayofmonth("dt_transacao") == 3
    assert len(incremental.refresh(spark, raw.where(~late), dims, root)) == 7
    again = raw.where(late | (F.dayofmonth("dt_transacao") == 4))
    assert incremental.refresh(spark, again, dims, root) == [dt.date(2024, 1, 3)]
    rebuilt(spark, root, raw, dims)
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "lake" / incremental.BRANCH_DAY).glob("dt=*/*.parquet")}
    assert incremental.refresh(spark, raw, dims, root) == []
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "lake" / incremental.BRANCH_DAY).glob("dt=*/*.parquet")}
    incremental.refresh_gold(spark, [dt.date(2024, 1, 3)], root)  # a failed run is made good by running it again
    rebuilt(spark, root, raw, dims)


def test_nothing_arrives(spark, raw, dims, tmp_path):
    assert incremental.refresh(spark, raw.limit(0), dims, str(tmp_path / "lake")) == []
    assert incremental.refresh(spark, raw.where("transacao_id is null"), dims, str(tmp_path / "lake")) == []


def test_only_touched_days_are_read(spark, raw, dims, tmp_path):
    root = str(tmp_path / "lake")
    incremental.refresh(spark, raw, dims, root)
    touched = incremental._only(tables.read_table(spark, f"{root}/{incremental.SILVER}"), "dt", [dt.date(2024, 1, 3)])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [(dt" in plan or "2024-01-03" in plan.split("PartitionFilters")[1]


def test_stream_to_silver_with_copies_late_files_and_a_replay(spark, raw, dims, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    late = F.dayofmonth("dt_transacao") == 3
    for part in (raw.where(~late), raw.where(late), raw.where(F.dayofmonth("dt_transacao") == 4)):
        part.repartition(3).write.mode("append").option("timestampNTZFormat", form).json(landing)
        incremental.start_silver_stream(spark, landing, dims, root, str(tmp_path / "c"), drain=True, files_per_trigger=2).awaitTermination()
    want = materialise(medallion.silver_plan(raw, dims, PARAMS), "want")
    stored = tables.read_table(spark, f"{root}/{incremental.SILVER}")
    assert same(stored.select(*want.columns), want)
    # Without its checkpoint the stream takes every file again.
    incremental.start_silver_stream(spark, landing, dims, root, str(tmp_path / "d"), drain=True).awaitTermination()
    assert same(tables.read_table(spark, f"{root}/{incremental.SILVER}").select(*want.columns), want)


def test_rejects_and_kept_rows_are_all_rows(spark, raw, tmp_path):
    odd = raw.unionByName(raw.limit(5).withColumn("dt_transacao", F.lit(None).cast("timestamp_ntz")))
    odd = materialise(odd.unionByName(raw.limit(4).withColumn("valor", F.lit(float("nan")))).withColumn("u", F.lit("x")), "odd")
    kept, rejected, counts = silver.split_rejects(odd, str(tmp_path / "r"))
    assert same(kept, silver.clean(odd))
    assert counts["linhas"] == odd.count() == kept.count() + rejected.count()
    found = {r[0]: r[1] for r in rejected.groupBy("motivo_rejeicao").count().collect()}
    assert found == {k: v for k, v in counts.items() if v and k != "linhas"}
    assert counts["SEM_DATA"] > 0 and counts["VALOR_AUSENTE"] > 0 and counts["DUPLICADA"] > 0
    with pytest.raises(silver.TooManyRejects, match="of"):
        silver.split_rejects(odd, str(tmp_path / "s"), max_share=0.0)
    kept, rejected, counts = silver.split_rejects(odd.limit(0), str(tmp_path / "t"), max_share=0.0)
    assert counts["linhas"] == 0 and kept.isEmpty() and rejected.isEmpty()


def test_cube_levels_agree_with_single_tests(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["A", "A", "A", "B", None]), rnd.choice(["2024-01", "2024-02"]), rnd.choice([10 ** rnd.uniform(0, 5), 7.0, 0.0, None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "tipo string, ano_mes string, valor double").withColumn("linhas_", F.lit(1))
    cube = benford.benford_cube(df, PARAMS)
    got = {(r["nivel"], r["chave"]): r for r in cube.collect()}
    assert len(got) == 4 + 2 + 2 + 1 and cube.count() == len(got)
    for level, key in (("tipo", F.col("tipo")), ("ano_mes", F.col("ano_mes")), ("", F.lit("")), ("tipo+ano_mes", F.concat_ws("|", "tipo", "ano_mes"))):
        one = df.withColumn("k", key) if level != "tipo+ano_mes" else df.where("tipo is not null").withColumn("k", key)
        single = benford.benford_by_segment(one, PARAMS, "k").collect()
        assert len(single) == sum(n == level for n, _ in got)
        for r in single:
            cell = got[(level, r["chave"])]
            assert (cell["alerta"], cell["score"]) == (r["alerta"], pytest.approx(r["score"]))
            assert (cell["chi2"], cell["mad"]) == (pytest.approx(r["chi2"]), pytest.approx(r["mad"]))
    assert benford.benford_cube(df.limit(0), PARAMS).count() == 0
    assert {r["nivel"] for r in benford.benford_cube(df, PARAMS, levels=(("tipo",),)).collect()} == {"tipo"}


def test_drift_of_features(spark):
    rnd = np.random.default_rng(4)
    rows = [(w, float(rnd.normal(3 * (w == 2), 1)), float(k % 3), None) for w in (0, 1, 2) for k in range(400)]
    df = materialise(spark.createDataFrame(rows + [(1, float("nan"), None, None)], "w int, a double, b double, c double"), "d")
    base = materialise(evaluation.feature_baseline(df.where("w = 0"), ("a", "b", "c")), "b")
    assert {r[0]: r[1] for r in base.groupBy("variavel").agg(F.round(F.sum("parte"), 9)).collect()} == {"a": 1.0, "b": 1.0}
    psi = {(r["variavel"], r["periodo"]): r["psi"] for r in evaluation.feature_drift(df, base, F.col("w"), ("a", "b", "c")).collect()}
    assert set(psi) == {(v, w) for v in "ab" for w in range(3)}
    assert psi["a", 0] == pytest.approx(0) and psi["b", 1] == pytest.approx(0, abs=1e-3) and psi["a", 1] < 0.2 < 2 < psi["a", 2]
    x = np.array([r[1] for r in rows if r[0] == 0])
    y = np.array([r[1] for r in rows if r[0] == 2])
    edges = np.quantile(x, np.arange(1, 10) / 10)
    e, a = (np.maximum(np.bincount((v[:, None] > edges).sum(axis=1), minlength=10) / 400, 1e-4) for v in (x, y))
    assert psi["a", 2] == pytest.approx(float(((a - e) * np.log(a / e)).sum()))
    old = {r["periodo"]: r["psi"] for r in evaluation.psi_by_period(df, "b", F.col("w"), F.col("w") == 0).collect()}
    assert all(math.isclose(psi["b", w], old[w], abs_tol=1e-9) for w in range(3))


def test_store_keeps_versions_and_thresholds(spark, tmp_path):
    matrix = materialise(spark.range(400).select(
        F.concat(F.lit("t"), "id").alias("transacao_id"), F.when(F.col("id") % 2 == 0, "APP").alias("canal"),
        *[F.rand(k).alias(c) for k, c in enumerate(FEATURE_COLUMNS)]), "m")
    from txwatch.operators import isolation_forest as forest

    nodes = forest.grow_forest(matrix, trees=3, group="canal")
    base = evaluation.feature_baseline(matrix, FEATURE_COLUMNS)
    fit = calibrator.Calibrator(np.arange(7.0), np.ones(7), np.full(7, 2.0), -0.5, 0.75, 60)
    path = str(tmp_path / "models")
    first = model_store.save_models(spark, medallion.Models(nodes, None, fit, 0.61, "canal", base), path)
    loaded = model_store.load_models(spark, path)
    assert (loaded.forest_p99, loaded.forest_group, loaded.autoencoder) == (0.61, "canal", None)
    assert loaded.calibrator.weights.tolist() == list(range(7)) and loaded.calibrator.rows == 60
    assert same(loaded.baseline, base) and {r["metrica"] for r in model_store.load_metrics(spark, path).collect()} == {"score_p99", "val_auc", "n_train"}
    # Loaded models are lazy; saving them where they came from must not lose them.
    second = model_store.save_models(spark, loaded, path)
    assert second != first and same(model_store.load_models(spark, path).forest_nodes, nodes)
    model_store.save_models(spark, medallion.Models(), path)
    assert model_store.load_models(spark, path) == medallion.Models()


def test_network_without_training_is_reproducible(spark):
    rows = [(f"AS{i}", "2026-01", *[float((i * k) % 17) for k in range(1, 10)]) for i in range(60)]
    df = materialise(spark.createDataFrame(rows, "associado_id string, ano_mes string, " + ", ".join(f"{c} double" for c in facts.PROFILE_COLUMNS)), "p")
    model = ae.train_autoencoder(df, epochs=0)
    assert model.history == [] and np.array_equal(model.weights, ae.initial_weights(9, 42))
    assert np.abs(model.weights).max() <= 1 / math.sqrt(8) and model.weights.std() > 0.1
    found = ae.autoencoder_findings(df, model)
    assert found.count() == 60 == found.where("score between 0 and 1 and alerta = (motivo is not null)").count()
