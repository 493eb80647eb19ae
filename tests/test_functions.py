"""Column functions, exact quantiles and hot-key handling against plain Python."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txwatch.functions.columns import first_digit, severity, wall_micros
from txwatch.functions.hotkeys import sliced_running_sums
from txwatch.functions.quantiles import exact_quantiles
from txwatch.params import Params


def test_first_digit(spark):
    values = [12.5, 7.3, 1500.0, 0.045, 0.3, 0.6, 0.7, 1e-7, 12345678.9, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    digits = [r[0] for r in df.orderBy("i").select(first_digit(F.col("v"))).collect()]
    assert digits == [1, 7, 1, 4, 3, 6, 7, 1, 1, None]


def test_severity_bands(spark):
    scores = [0.3, 0.5, 0.6, 0.7, 0.75, 0.85, 0.9, 0.95, 0.97]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    names = [r[0] for r in df.orderBy("s").select(severity(F.col("s"), Params())).collect()]
    assert names == [
        None, "BAIXA", "BAIXA", "MEDIA", "MEDIA", "ALTA", "ALTA", "CRITICA", "CRITICA"
    ]


def test_wall_micros_ignores_the_session_zone(spark):
    moment = dt.datetime(2018, 11, 4, 0, 30, 1, 250_001)  # inside a DST gap of Sao Paulo
    expected = (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    for zone in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.sql("select timestamp_ntz'2018-11-04 00:30:01.250001' as t")
            assert df.select(wall_micros("t")).first()[0] == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind", ["lognormal", "ties", "few", "one", "outlier"])
def test_exact_quantiles_match_linear_interpolation(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "lognormal": rng.lognormal(3, 2, 30_000),
        "ties": rng.integers(0, 7, 5_000).astype(float),
        "few": np.array([5.0, -1.0, 2.5]),
        "one": np.array([4.0]),
        "outlier": np.concatenate([rng.random(20_000), [1e15, -1e15]]),
    }[kind]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(7)
    got = {r["prob"]: r["quantil"] for r in exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)


def test_exact_quantiles_per_key_ignore_nulls(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": np.repeat(["a", "b", "c"], 500), "v": rng.normal(size=1500)})
    rows = [(k, None if i % 7 == 0 else float(v)) for i, (k, v) in enumerate(pdf.to_numpy())]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["quantil"] for r in exact_quantiles(df, "v", [0.5], ("k",)).collect()}
    known = pd.DataFrame(rows, columns=["k", "v"]).dropna()
    for key, group in known.groupby("k"):
        assert got[key] == pytest.approx(group["v"].median(), abs=1e-12)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0


def test_exact_quantiles_do_not_test_their_join_keys_by_copies(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "cast(id as double) as v")
    found = exact_quantiles(df, "v", [i / 10 for i in range(1, 10)], ("k",))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if line.count("isnotnull(") and line.count("_cuts#") > 40]


def test_sliced_sums_equal_plain_running_sums(spark):
    rng = np.random.default_rng(5)
    rows = [
        (str(k), int(t), int(v))
        for k, t, v in zip(
            rng.choice(["a", "b"], 3000, p=[0.9, 0.1]),
            rng.integers(-500, 2000, 3000),
            rng.integers(-3, 9, 3000),
        )
    ]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint")
    past = "over (partition by k order by t range between unbounded preceding and current row)"
    plain = df.selectExpr("k", "t", f"sum(v) {past} as v").orderBy("k", "t", "v").collect()
    for width in (1, 60, 10_000):
        sliced = sliced_running_sums(df, "k", "t", ["v"], width)
        assert sliced.select("k", "t", "v").orderBy("k", "t", "v").collect() == plain


def test_sliced_sums_sort_no_row_twice(spark):
    df = spark.createDataFrame([("a", t, 1) for t in range(500)], "k string, t bigint, v bigint")
    plan = sliced_running_sums(df, "k", "t", ["v"], 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
