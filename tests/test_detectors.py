"""Statistical detectors against step-by-step Python recursions and the agreed examples."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

from txwatch.operators import benford, control_charts, structuring
from txwatch.params import Params

PARAMS = Params()
DAY = dt.date(2026, 1, 1)


def series(spark, groups: dict[str | None, list[float]]):
    rows = [
        (key, DAY + dt.timedelta(days=i), float(x))
        for key, xs in groups.items()
        for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(rows, "k string, dt date, x double").repartition(5)


def by_key(df, *columns):
    out: dict = {}
    for row in df.orderBy("k", "dt").collect():
        out.setdefault(row["k"], []).append(tuple(row[c] for c in columns))
    return out


def walk_cusum(xs, slack=0.5, limit=5.0):
    mean = np.mean(xs)
    sd = np.std(xs, ddof=1) if len(xs) > 1 else 0.0
    sd = sd if sd > 0 else 1.0
    high = low = 0.0
    for x in xs:
        high = max(0.0, high + x - mean - slack * sd)
        low = min(0.0, low + x - mean + slack * sd)
        yield high, low, bool(high > limit * sd or low < -limit * sd)


def walk_ewma(xs, lam, width=3.0):
    mean = np.mean(xs)
    sd = np.std(xs, ddof=1) if len(xs) > 1 else 0.0
    sd = sd if sd > 0 else 1.0
    z = mean
    for i, x in enumerate(xs, 1):
        z = lam * x + (1 - lam) * z
        reach = width * sd * np.sqrt(lam / (2 - lam) * (1 - (1 - lam) ** (2 * i)))
        yield z, mean + reach, mean - reach


def test_cusum_equals_the_recursion(spark):
    rng = np.random.default_rng(0)
    groups = {
        "shift": [*rng.normal(100, 5, 50), *rng.normal(140, 5, 20)],
        "noise": list(rng.normal(50, 2, 200)),
        "flat": [7.0] * 9,
        "single": [3.0],
        None: [1.0, 2.0],
    }
    got = by_key(
        control_charts.cusum_series(series(spark, groups), "k", "dt", "x", PARAMS),
        "s_h", "s_l", "alerta",
    )
    assert None not in got
    for key in ("shift", "noise", "flat", "single"):
        want = list(walk_cusum(groups[key]))
        assert np.allclose([r[:2] for r in got[key]], [w[:2] for w in want], atol=1e-8)
        assert [r[2] for r in got[key]] == [w[2] for w in want]
    assert got["shift"][-1][2] and not got["shift"][10][2]


def test_cusum_score_and_text(spark):
    rng = np.random.default_rng(0)
    xs = [*rng.normal(100, 5, 50), *rng.normal(140, 5, 20)]
    rows = control_charts.cusum(series(spark, {"AG1": xs}), "k", "dt", "x", PARAMS).collect()
    assert len(rows) == 70 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["motivo"] for r in rows} == {None, "CUSUM fora dos limites em AG1"}
    assert all((r["motivo"] is not None) == r["alerta"] for r in rows)


@pytest.mark.parametrize("lam", [0.2, 0.01, 0.9, 1.0])
def test_ewma_equals_the_recursion(spark, lam):
    rng = np.random.default_rng(1)
    groups = {
        "noise": list(rng.normal(50, 2, 100)),
        "long": list(rng.lognormal(3, 1, 5000)),
        "flat": [2.0] * 6,
        "five": [1.0, 2.0, 3.0, 4.0, 50.0],
        "four": [1.0, 2.0, 3.0, 4.0],
    }
    params = replace(PARAMS, ewma_weight=lam)
    got = by_key(
        control_charts.ewma_series(series(spark, groups), "k", "dt", "x", params),
        "z", "superior", "inferior", "alerta",
    )
    assert "four" not in got
    for key, rows in got.items():
        want = list(walk_ewma(groups[key], lam))
        assert np.allclose([r[:3] for r in rows], want, rtol=1e-9, atol=1e-9)
    assert np.mean([r[3] for r in got["noise"]]) < 0.05


def test_hourly_limits(spark):
    rows = []
    for day in range(20):
        for hour in (9, 10):
            n = 60 if (day, hour) == (19, 10) else 3
            rows += [("AG1", dt.datetime(2026, 1, 1 + day, hour, i)) for i in range(n)]
    rows += [("AG2", dt.datetime(2026, 1, 1, 9, 0))] * 4  # a single observed hour
    rows += [("AG3", dt.datetime(2026, 1, 1 + d, 9, 0)) for d in range(3)]  # no variance
    rows += [(None, dt.datetime(2026, 1, 1, 9, 0))]
    df = spark.createDataFrame(rows, "agencia_id string, dt_transacao timestamp_ntz")
    found = control_charts.hourly_limits(df, PARAMS).toPandas()
    assert len(found) == 40 + 1 + 3
    alerts = found[found["alerta"]]
    assert len(alerts) == 1 and alerts.iloc[0]["hora"] == 10 and alerts.iloc[0]["score"] == 1.0
    single = found[found["agencia_id"] == "AG2"].iloc[0]
    assert not single["alerta"] and pd.isna(single["score"])
    assert (found[found["agencia_id"] == "AG3"]["score"] == 0).all()


def benford_sample(seed: int, low: int, spread: float, n: int = 2000) -> list[float]:
    rng = np.random.default_rng(seed)
    if low == 1:
        p = np.log10(1 + 1 / np.arange(1, 10))
        digits = rng.choice(np.arange(1, 10), size=n, p=p / p.sum())
    else:
        digits = rng.integers(low, 10, size=n)
    return [float(d * 10.0**e + u) for d, e, u in
            zip(digits, rng.integers(0, 4, n) if low == 1 else rng.integers(1, 4, n), rng.random(n) * spread)]


def test_benford_accepts_and_rejects(spark):
    rows = [("ok", v) for v in benford_sample(42, 1, 1.0)]
    rows += [("bad", v) for v in benford_sample(0, 5, 0.0)]
    rows += [("tiny", 1.0)] * 99 + [("edge", 1.0)] * 100
    df = spark.createDataFrame(rows, "tipo string, valor double")
    stats = {r["tipo"]: r for r in benford.benford_statistics(df, "tipo", PARAMS).collect()}
    assert stats["ok"]["p_value"] > 0.01 and stats["ok"]["mad"] < 0.02
    assert stats["bad"]["mad"] > 0.05 and stats["bad"]["p_value"] < 1e-6
    found = {r["chave"]: r for r in benford.benford_by_segment(df, PARAMS).collect()}
    assert set(found) == {"ok", "bad", "edge"}
    assert found["bad"]["alerta"] and found["bad"]["score"] == 1.0
    assert found["bad"]["motivo"].startswith("Benford: MAD=0.") and "(tipo=bad)" in found["bad"]["motivo"]


def test_benford_counts_unseen_digits(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50, "tipo string, valor double")
    histogram = benford.digit_histogram(df, "tipo").orderBy("digito").collect()
    assert [r["qtd"] for r in histogram] == [50] + [0] * 8
    p = np.log10(1 + 1 / np.arange(1, 10))
    mad = np.mean(np.abs(np.array([1] + [0] * 8) - p))
    stats = benford.benford_statistics(df, "tipo", PARAMS).first()
    assert stats["mad"] == pytest.approx(mad)
    assert stats["chi2"] == pytest.approx(sum((o - e) ** 2 / e for o, e in zip([50] + [0] * 8, 50 * p)))


def test_chi_square_tail_at_a_tabled_point(spark):
    value = spark.sql(
        "select exp(-x/2)*(1 + x/2 + pow(x/2,2)/2 + pow(x/2,3)/6) from values (15.507313055865453D) t(x)"
    ).first()[0]
    assert value == pytest.approx(0.05, abs=1e-9)


def payments(spark, rows):
    schema = "transacao_id string, associado_id string, dt_transacao timestamp_ntz, tipo string, valor double"
    return spark.createDataFrame(
        [(f"t{i}", *row) for i, row in enumerate(rows)], schema
    ).repartition(3)


def test_structuring_example(spark):
    start = dt.datetime(2026, 5, 1, 9)
    rows = [("A", start + dt.timedelta(hours=2 * i), "PIX_OUT", 4000.0) for i in range(5)]
    found = structuring.structuring(payments(spark, rows), PARAMS).collect()
    assert len(found) == 1
    row = found[0]
    assert (row["qtd_tx"], row["soma"], row["score"], row["alerta"]) == (3, 12000.0, 0.6, True)
    assert row["motivo"] == "Fracionamento: 3 tx somando R$ 12,000.00 em 24h"


def test_structuring_window_edges(spark):
    start = dt.datetime(2026, 5, 1, 9)
    micro = dt.timedelta(microseconds=1)
    day = dt.timedelta(hours=24)
    rows = [
        ("exact", start, "TED", 4000.0),
        ("exact", start + day - 2 * micro, "TED", 4000.0),
        ("exact", start + day, "TED", 4000.0),  # the first one left the window
        ("inside", start, "TED", 4000.0),
        ("inside", start + day - 2 * micro, "TED", 4000.0),
        ("inside", start + day - micro, "TED", 4000.0),
        ("tie", start, "TED", 4000.0),
        ("tie", start, "TED", 4000.0),
        ("tie", start, "PIX_OUT", 4000.0),  # simultaneous rows see each other
        ("large", start, "TED", 10_000.0),
        ("large", start, "TED", 10_000.0),
        ("large", start, "TED", 10_000.0),
        ("pair", start, "TED", 9_000.0),
        ("pair", start, "TED", 9_000.0),
        (None, start, "TED", 9_000.0),
        ("other", start, "SAQUE", 9_000.0),
    ]
    found = {r["associado_id"]: r for r in structuring.structuring(payments(spark, rows), PARAMS).collect()}
    assert set(found) == {"inside", "tie"}
    assert found["inside"]["qtd_tx"] == 1 and found["tie"]["qtd_tx"] == 3


def brute_windows(pdf: pd.DataFrame, params: Params) -> dict:
    kept = pdf[pdf["tipo"].isin(params.structuring_types) & (pdf["valor"] < params.structuring_limit)]
    out = {}
    for member, group in kept.groupby("associado_id"):
        times = group["dt_transacao"].to_numpy()
        for t in np.unique(times):
            inside = group[(times > t - np.timedelta64(params.structuring_hours, "h")) & (times <= t)]
            out[(member, pd.Timestamp(t))] = (len(inside), round(inside["valor"].sum(), 6))
    return out


@pytest.mark.parametrize("params", [PARAMS, Params(slice_seconds=1), Params(slice_seconds=10**8)])
def test_structuring_windows_equal_brute_force_at_any_slice(spark, params):
    rng = np.random.default_rng(9)
    n = 900
    members = rng.choice(["hot", "b", "c", "d"], n, p=[0.7, 0.1, 0.1, 0.1])
    seconds = rng.integers(0, 5 * 86_400, n)
    seconds[:50] = seconds[0]
    rows = [
        (str(m), dt.datetime(2026, 5, 1) + dt.timedelta(seconds=int(s)),
         str(rng.choice(["PIX_OUT", "TED", "SAQUE"])), round(float(rng.lognormal(8, 1)), 2))
        for m, s in zip(members, seconds)
    ]
    df = payments(spark, rows)
    want = brute_windows(df.toPandas(), params)
    got = {
        (r["associado_id"], pd.Timestamp(r["dt_transacao"])):
            (r["qtd_janela"], round(float(r["soma_janela"]), 6))
        for r in structuring.structuring_windows(df, params).collect()
    }
    assert got == want
