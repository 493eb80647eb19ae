"""Features, isolation forest, autoencoder and calibrator."""

from __future__ import annotations

import datetime as dt
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txwatch.operators import autoencoder as ae
from txwatch.operators import calibrator, facts
from txwatch.operators import isolation_forest as forest
from txwatch.operators.features import FEATURE_COLUMNS, member_features
from txwatch.params import Params
from txwatch.session import materialise

SCHEMA = (
    "transacao_id string, associado_id string, agencia_id string, valor double, "
    "dt_transacao timestamp_ntz, conta_destino string, canal string, geo_lat double, geo_lon double, "
    "score_risco double, dt_adesao date"
)


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(700):
        member = None if i % 50 == 0 else str(rng.choice(["hot", "b", "c", "d"], p=[0.7, 0.1, 0.1, 0.1]))
        placed = rng.random() < 0.8
        rows.append(
            (
                f"t{i}",
                member,
                "AG1",
                round(float(rng.lognormal(5, 1)), 2),
                dt.datetime(2026, 3, 1) + dt.timedelta(seconds=int(rng.integers(0, 90 * 86_400))),
                None if rng.random() < 0.3 else f"p{rng.integers(0, 25)}",
                "APP",
                float(rng.normal(-16, 1)) if placed else None,
                float(rng.normal(-49, 1)) if placed else None,
                None if member == "b" else 0.5,
                None if member == "c" else dt.date(2026, 4, 1),
            )
        )
    for i in range(1, 60):  # many rows at one instant
        rows[i] = (*rows[i][:4], rows[2][4], *rows[i][5:])
    for i in range(100, 130):  # NaN stands for a missing value
        rows[i] = (*rows[i][:7], float("nan"), float("nan"), float("nan"), rows[i][10])
    rows[140] = (*rows[140][:3], float("nan"), *rows[140][4:])
    return materialise(spark.createDataFrame(rows, SCHEMA), "history")


def brute_features(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for row in pdf.itertuples():
        mine = pdf[pdf["associado_id"] == row.associado_id] if row.associado_id else pdf.iloc[:0]
        past = mine[mine["dt_transacao"] <= row.dt_transacao]

        def recent(days):
            return int((past["dt_transacao"] > row.dt_transacao - pd.Timedelta(days=days)).sum())

        age = (row.dt_transacao.date() - row.dt_adesao).days if row.dt_adesao else 0
        lat, lon = mine["geo_lat"].median(), mine["geo_lon"].median()
        away = 0.0
        if not (pd.isna(row.geo_lat) or pd.isna(lat)):
            away = float(np.hypot(row.geo_lat - lat, row.geo_lon - lon))
        out.append(
            (
                row.transacao_id, 0.0 if pd.isna(row.valor) else row.valor,
                np.log1p(0.01 if pd.isna(row.valor) else max(row.valor, 0.01)), row.dt_transacao.hour,
                row.dt_transacao.dayofweek, recent(7), recent(30), past["conta_destino"].nunique(),
                max(age, 0), 0.3 if pd.isna(row.score_risco) else row.score_risco,
                row.valor / mine["valor"].mean() if len(mine) and not pd.isna(row.valor) else 1.0, away,
            )
        )
    return pd.DataFrame(out, columns=["transacao_id", *FEATURE_COLUMNS])


@pytest.mark.parametrize("params", [Params(), Params(slice_seconds=1), Params(slice_seconds=10**8)])
def test_features_equal_brute_force_at_any_slice(history, params):
    got = member_features(history, params).toPandas().set_index("transacao_id").sort_index()
    want = brute_features(history.toPandas()).set_index("transacao_id").sort_index()
    assert list(got.columns) == list(FEATURE_COLUMNS)
    assert len(got) == 700 and not got.isna().any().any()
    pd.testing.assert_frame_equal(got, want.astype(float), atol=1e-9, rtol=1e-9)


def test_features_without_member_attributes(history):
    bare = history.drop("score_risco", "dt_adesao")
    row = member_features(bare, Params()).first()
    assert row["score_risco_assoc"] == 0.3 and row["idade_conta_dias"] == 0.0


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(FEATURE_COLUMNS)))
    x[:15] += 9.0
    pdf = pd.DataFrame(x, columns=list(FEATURE_COLUMNS))
    pdf.insert(0, "transacao_id", [f"t{i:05d}" for i in range(len(pdf))])
    return materialise(spark.createDataFrame(pdf), "cloud")


def test_forest_ranks_planted_outliers_first(spark, cloud):
    nodes = materialise(forest.grow_forest(cloud), "nodes")
    table = nodes.toPandas()
    assert table["arvore"].nunique() == forest.TREES
    roots = table[table["no"] == 1]
    assert (roots["tamanho"] == forest.SAMPLE).all() and table["profundidade"].max() <= 8
    leaves = table[table["coluna"] < 0].groupby("arvore")["tamanho"].sum()
    assert (leaves == forest.SAMPLE).all()

    raw = materialise(forest.forest_scores(cloud, nodes), "raw")
    found = forest.normalise(raw).toPandas().sort_values("score", ascending=False)
    assert found["score"].min() == 0.0 and found["score"].max() == 1.0
    assert set(found["transacao_id"][:15]) == {f"t{i:05d}" for i in range(15)}
    assert found["alerta"].sum() == 30
    assert (found["motivo"].notna() == found["alerta"]).all()


def test_forest_does_not_depend_on_partitions(cloud):
    one = forest.grow_forest(cloud.coalesce(1), trees=20).toPandas()
    many = forest.grow_forest(cloud.repartition(13), trees=20).toPandas()
    key = ["arvore", "no"]
    pd.testing.assert_frame_equal(
        one.sort_values(key).reset_index(drop=True), many.sort_values(key).reset_index(drop=True)
    )
    other = forest.grow_forest(cloud, trees=20, seed=7).toPandas()
    assert not one.sort_values(key)["corte"].reset_index(drop=True).equals(
        other.sort_values(key)["corte"].reset_index(drop=True)
    )


def brute_score(table: pd.DataFrame, row: np.ndarray) -> float:
    """Score of one row by walking node by node."""
    total, trees = 0.0, table["arvore"].unique()
    for tree in trees:
        nodes, at = table[table["arvore"] == tree].set_index("no"), 1
        while nodes.at[at, "coluna"] >= 0:
            right = row[nodes.at[at, "coluna"]] > nodes.at[at, "corte"]
            at = nodes.at[at, "direita"] if right else nodes.at[at, "esquerda"]
        total += nodes.at[at, "profundidade"] + forest.average_path(nodes.at[at, "tamanho"])
    return 2 ** (-total / len(trees) / forest.average_path(table[table["no"] == 1]["tamanho"].max()))


def test_walk_equals_brute_force(cloud):
    few = cloud.orderBy("transacao_id").limit(40)
    nodes = forest.grow_forest(cloud, trees=7)
    table = nodes.toPandas()
    got = {r["transacao_id"]: r["bruto"] for r in forest.forest_scores(few, nodes).collect()}
    for row in few.toPandas().itertuples(index=False):
        assert got[row[0]] == pytest.approx(brute_score(table, np.round(np.array(row[1:], dtype=float), 6)), abs=1e-9)


def test_sample_is_the_lowest_draws(cloud):
    rows = forest.with_group(cloud).select("grupo", "transacao_id")
    picked = forest.sample_rows(rows, trees=3, sample=20).toPandas()

    def draw(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)

    ids = [r[0] for r in cloud.select("transacao_id").collect()]
    for tree in range(3):
        want = sorted(ids, key=lambda i: (draw(42, tree, i), i))[:20]
        assert sorted(picked[picked["arvore"] == tree]["transacao_id"]) == sorted(want)


def test_forest_per_group(spark, cloud):
    name = "case when id % 10 < 6 then 'hot' when id % 10 < 9 then 'b' when id % 20 = 9 then 'few' end as canal"
    grouped = cloud.selectExpr("*", "cast(substring(transacao_id, 2) as int) as id").selectExpr(*cloud.columns, name)
    grouped = materialise(grouped, "grouped")
    nodes = forest.grow_forest(grouped, trees=5, group="canal")
    table = nodes.toPandas()
    assert set(table["grupo"]) == {"hot", "b", forest.REST}
    assert (table[table["no"] == 1]["tamanho"] == forest.SAMPLE).all()
    alone = forest.grow_forest(grouped.where("canal = 'b'"), trees=5, group="canal").toPandas()
    key = ["arvore", "no"]
    pd.testing.assert_frame_equal(
        alone.sort_values(key).reset_index(drop=True),
        table[table["grupo"] == "b"].sort_values(key).reset_index(drop=True),
    )
    odd = grouped.withColumn("canal", F.when(F.col("canal") == "few", "new").otherwise(F.col("canal")))
    raw = materialise(forest.forest_scores(odd, nodes, group="canal"), "raw")
    assert raw.count() == 3000 and raw.where("bruto is null").isEmpty()
    assert {r[0] for r in raw.select("grupo").distinct().collect()} == {"hot", "b", forest.REST}
    found = forest.normalise(raw).groupBy("grupo").agg(F.min("score"), F.max("score"), F.count_if("alerta"))
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {
        "hot": (0.0, 1.0, 18), "b": (0.0, 1.0, 9), forest.REST: (0.0, 1.0, 3)}
    none = forest.forest_scores(odd, nodes.where("grupo <> '*'"), group="canal")
    assert none.where("bruto is null").count() == 300 and forest.normalise(materialise(none, "raw")).count() == 2700


def test_forest_of_equal_rows_and_no_rows(spark, cloud):
    same = spark.range(50).select(F.concat(F.lit("t"), "id").alias("transacao_id"), *[F.lit(0.5).alias(c) for c in FEATURE_COLUMNS])
    nodes = forest.grow_forest(same, trees=4)
    assert nodes.count() == 4 and nodes.where("coluna >= 0").isEmpty()
    found = forest.normalise(materialise(forest.forest_scores(same, nodes), "raw"))
    assert found.where("score = 0 and alerta").count() == 50
    nothing = same.limit(0)
    assert forest.grow_forest(nothing, trees=4).count() == 0
    assert forest.forest_scores(nothing, nodes).count() == 0


@pytest.mark.parametrize("rows", [1, 10, 300, 1500])
def test_forest_on_small_batches(cloud, rows):
    few = cloud.orderBy("transacao_id").limit(rows)
    nodes = forest.grow_forest(few, trees=10).toPandas()
    assert nodes["arvore"].nunique() == 10
    assert (nodes[nodes["no"] == 1]["tamanho"] == min(rows, forest.SAMPLE)).all()


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(7, 9))
    flat = ae.initial_weights(9, 1)
    assert len(flat) == 593
    _, slope = ae.loss_and_gradient(flat, x)
    for i in rng.choice(len(flat), 25, replace=False):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up, _ = ae.loss_and_gradient(flat + step, x)
        down, _ = ae.loss_and_gradient(flat - step, x)
        assert slope[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


@pytest.fixture(scope="module")
def profiles(spark):
    rng = np.random.default_rng(6)
    hidden = rng.normal(size=(900, 3))
    x = hidden @ rng.normal(size=(3, 9)) + 0.05 * rng.normal(size=(900, 9)) + 20
    pdf = pd.DataFrame(x, columns=list(facts.PROFILE_COLUMNS))
    pdf.insert(0, "ano_mes", "2026-01")
    pdf.insert(0, "associado_id", [f"AS{i}" for i in range(900)])
    return materialise(spark.createDataFrame(pdf), "profiles"), pdf


def test_autoencoder_learns_and_flags_a_planted_profile(spark, profiles):
    table, pdf = profiles
    model = ae.train_autoencoder(table, epochs=60, epochs_per_round=20, batch_size=64)
    assert [step for step, _, _ in model.history] == [20, 40, 60]
    assert model.history[-1][1] < 0.7 * model.history[0][1]
    assert 0 < model.threshold < 100
    odd = pdf.iloc[:1].copy()
    odd["associado_id"] = "odd"
    odd[list(facts.PROFILE_COLUMNS)] += 40 * np.array([1, -1, 1, -1, 1, -1, 1, -1, 1])
    found = ae.autoencoder_findings(spark.createDataFrame(odd), model).first()
    assert found["alerta"] and found["score"] == 1.0
    again = ae.train_autoencoder(table, epochs=20, epochs_per_round=20, batch_size=64)
    assert again.history[0][1] == pytest.approx(model.history[0][1], rel=1e-9)


def test_autoencoder_averages_several_shards(profiles):
    model = ae.train_autoencoder(profiles[0], epochs=30, epochs_per_round=5, batch_size=64, rows_per_shard=300)
    assert model.history[-1][1] < model.history[0][1] and np.isfinite(model.weights).all()


def test_error_findings_arithmetic(spark):
    errors = spark.createDataFrame(
        [("a", "m", 0.5), ("b", "m", 1.0), ("c", "m", 5.0)], "associado_id string, ano_mes string, erro double"
    )
    rows = {r["associado_id"]: r for r in ae.error_findings(errors, 1.0).collect()}
    assert [rows[k]["score"] for k in "abc"] == [0.25, 0.5, 1.0]
    assert [rows[k]["alerta"] for k in "abc"] == [False, False, True]


@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(8)
    x = rng.random((600, len(calibrator.SCORE_COLUMNS)))
    odds = 6 * x[:, 5] + 3 * x[:, 4] - 4.5
    y = (rng.random(600) < 1 / (1 + np.exp(-odds))).astype(int)
    pdf = pd.DataFrame(x, columns=list(calibrator.SCORE_COLUMNS))
    pdf["confirmado"] = y
    pdf["alerta_id"] = [f"a{i}" for i in range(600)]
    return materialise(spark.createDataFrame(pdf), "judged")


def test_calibrator_is_a_stationary_point_and_separates(judged):
    fitted = calibrator.train_calibrator(judged)
    assert fitted.rows == 600 and fitted.auc > 0.75
    scored = calibrator.apply_calibrator(fitted, judged).toPandas()
    assert scored["prob_confirmacao"].between(0, 1).all()
    # Gradient of |w|^2 / 2 + C * sum of log losses over the training part vanishes at the optimum.
    pdf = judged.toPandas()
    lot = np.array([int(hashlib.md5(f"42:{a}".encode()).hexdigest()[:13], 16) for a in pdf["alerta_id"]], dtype=float)
    cut = {y: np.quantile(lot[pdf["confirmado"] == y], 0.25) for y in (0, 1)}
    kept = lot > pdf["confirmado"].map(cut).to_numpy()
    assert abs(kept.sum() - 450) <= 1
    raw = pdf[list(calibrator.SCORE_COLUMNS)].to_numpy()
    np.testing.assert_allclose(fitted.mean, raw.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(fitted.deviation, raw.std(axis=0), rtol=1e-9)
    xs, y = ((raw - fitted.mean) / fitted.deviation)[kept], pdf["confirmado"].to_numpy()[kept]
    p = 1 / (1 + np.exp(-(xs @ fitted.weights + fitted.intercept)))
    assert np.abs(fitted.weights + xs.T @ (p - y)).max() < 1e-8 and abs((p - y).sum()) < 1e-8
    again = calibrator.train_calibrator(judged.repartition(7))
    np.testing.assert_allclose(again.weights, fitted.weights, atol=1e-10)


@pytest.mark.parametrize("kind", ["separable", "constant", "nulls"])
def test_calibrator_on_hard_tables(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.random((200, len(calibrator.SCORE_COLUMNS)))
    y = (x[:, 0] > 0.5).astype(int)
    pdf = pd.DataFrame(x, columns=list(calibrator.SCORE_COLUMNS))
    if kind == "constant":
        pdf[list(calibrator.SCORE_COLUMNS[1:])] = 0.25
    pdf["confirmado"], pdf["alerta_id"] = y, [f"a{i // 2}" for i in range(200)]
    df = spark.createDataFrame(pdf).withColumn("p", F.lit("clash"))
    if kind == "nulls":
        df = df.withColumn("score_D2_EWMA", F.when(F.col("score_D2_EWMA") > 0.5, F.col("score_D2_EWMA")))
        df = df.withColumn("score_D4_BENFORD", F.lit(None).cast("double"))
    fitted = calibrator.train_calibrator(materialise(df, "hard"))
    assert np.isfinite(fitted.weights).all() and fitted.auc > 0.95
    if kind != "separable":
        assert abs(fitted.weights[3]) < 1e-9 and fitted.deviation[3] == 1.0
    scored = calibrator.apply_calibrator(fitted, df)
    assert scored.columns == [*df.columns, "prob_confirmacao"] and scored.where("prob_confirmacao is null").isEmpty()


def test_calibrator_refuses_thin_history(judged):
    with pytest.raises(ValueError):
        calibrator.train_calibrator(judged.limit(20))
    with pytest.raises(ValueError):
        calibrator.train_calibrator(judged.where("confirmado = 1"))


def test_training_set_fills_missing_scores(spark):
    alerts = spark.createDataFrame(
        [("a", "CONFIRMADO"), ("b", "FALSO_POSITIVO"), ("c", "ABERTO")], "alerta_id string, status string"
    )
    scores = spark.createDataFrame([("a", "D1_CUSUM", 0.4)], "alerta_id string, regra_id string, score double")
    rows = {r["alerta_id"]: r for r in calibrator.training_set(alerts, scores).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["score_D1_CUSUM"] == 0.4 and rows["a"]["confirmado"] == 1
    assert rows["b"]["score_D1_CUSUM"] == 0.0 and rows["b"]["score_M2_AUTOENCODER"] == 0.0
