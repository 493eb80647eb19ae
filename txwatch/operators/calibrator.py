"""Rule M3: logistic calibration of detector scores against auditor verdicts, by Newton steps.

A step needs only sums over the training rows: the loss, eight slopes and the 36 different products of an 8 x 8
matrix. They are one combinable aggregate; the step itself is solved on these numbers. Nothing but sums reaches
the driver, and the result depends neither on the order nor on the partitions of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.params import DEFAULT_WEIGHTS
from txwatch.session import materialise

SCORE_COLUMNS = tuple(f"score_{rule}" for rule in DEFAULT_WEIGHTS)
VERDICTS = ("CONFIRMADO", "FALSO_POSITIVO")
MIN_LABELLED = 50
_STEPS, _TINY = 100, 1e-9


@dataclass(frozen=True)
class Calibrator:
    #: Per score column the weight of the standardised score, its mean and deviation.
    weights: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    intercept: float
    #: Area under the ROC curve on the held-out quarter, and the number of labelled rows.
    auc: float
    rows: int


def wide_scores(scores: DataFrame, key: str = "alerta_id") -> DataFrame:
    """One row per key, one column per detector: its highest score."""
    rules = [c.removeprefix("score_") for c in SCORE_COLUMNS]
    return scores.groupBy(key).agg(
        *[F.max(F.when(F.col("regra_id") == r, F.col("score"))).alias(f"score_{r}") for r in rules]
    )


def training_set(alerts: DataFrame, scores: DataFrame, key: str = "alerta_id") -> DataFrame:
    """Alerts with a verdict, one column per detector score (missing: 0) and the label.

    `alerts` holds key and status; `scores` holds key, regra_id and score, at most a few rows per key.
    """
    wide = wide_scores(scores, key)
    judged = alerts.where(F.col("status").isin(*VERDICTS)).select(key, "status")
    return judged.join(wide, key, "left").select(
        key,
        (F.col("status") == "CONFIRMADO").cast("int").alias("confirmado"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in SCORE_COLUMNS],
    )


def _standardised(mean: np.ndarray, deviation: np.ndarray) -> list[Column]:
    return [(F.coalesce(F.col(c), F.lit(0.0)) - F.lit(float(m))) / F.lit(float(s))
            for c, m, s in zip(SCORE_COLUMNS, mean, deviation)]


def _odds(z: list[Column], weights: np.ndarray) -> Column:
    """Log odds; the last weight is the intercept."""
    total = F.lit(float(weights[-1]))
    for column, weight in zip(z, weights):
        total = total + column * F.lit(float(weight))
    return total


def _sums(train: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slopes and curvature of the log loss, summed over the rows (z0.., y)."""
    size = len(weights)
    x = [F.col(f"z{k}") for k in range(size - 1)] + [F.lit(1.0)]
    rows = train.withColumn("_odds", _odds(x[:-1], weights)).withColumn("_p", 1 / (1 + F.exp(-F.col("_odds"))))
    odds, p = F.col("_odds"), F.col("_p")
    loss = F.greatest(odds, F.lit(0.0)) - F.col("y") * odds + F.log1p(F.exp(-F.abs(odds)))
    pairs = [(a, b) for a in range(size) for b in range(a, size)]
    found = rows.agg(
        F.sum(loss), *[F.sum((p - F.col("y")) * v) for v in x], *[F.sum(p * (1 - p) * x[a] * x[b]) for a, b in pairs]
    ).first()
    curve = np.zeros((size, size))
    for (a, b), value in zip(pairs, found[1 + size :]):
        curve[a, b] = curve[b, a] = value
    return found[0], np.array(found[1 : 1 + size]), curve


def _newton(train: DataFrame, inverse_penalty: float) -> np.ndarray:
    """Minimum of |w|^2 / 2 + C x sum of log losses, the intercept (last) being free of the penalty."""
    ridge = np.append(np.ones(len(SCORE_COLUMNS)), 0.0)
    weights, step, best = np.zeros(len(ridge)), np.zeros(len(ridge)), np.inf
    for _ in range(_STEPS):
        loss, slope, curve = _sums(train, weights + step)
        value = inverse_penalty * loss + 0.5 * float(ridge @ (weights + step) ** 2)
        if value > best + _TINY * max(1.0, abs(best)):  # too far: the way is right, the length is not
            step = step / 2
            continue
        weights, best = weights + step, value
        full = inverse_penalty * curve + np.diag(ridge)
        step = -np.linalg.lstsq(full, inverse_penalty * slope + ridge * weights, rcond=None)[0]
        if np.abs(step).max() < _TINY:
            return weights + step
    return weights


def _lot(key: str, seed: int) -> Column:
    """Place of a row in the draw: 52 bits of the MD5 of seed and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def train_calibrator(
    labelled: DataFrame, key: str = "alerta_id", inverse_penalty: float = 1.0, seed: int = 42
) -> Calibrator:
    """L2 logistic regression on standardised scores, validated on a stratified quarter.

    The quarter is cut per class at the exact 25% point of a digest of the key, so no class is gathered or
    sorted. Null scores count as 0; a score that never varies has deviation 1. `labelled` is read several times
    and should be a stored table.
    """
    known = labelled.select(
        F.col("confirmado").cast("int").alias("confirmado"), _lot(key, seed).alias("_lot"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SCORE_COLUMNS],
    ).where("confirmado is not null")
    known = materialise(known, "calibration")
    cuts = {r["confirmado"]: (r["quantil"], r["n"]) for r in exact_quantiles(known, "_lot", [0.25], ("confirmado",)).collect()}
    rows = sum(n for _, n in cuts.values())
    if rows < MIN_LABELLED:
        raise ValueError(f"at least {MIN_LABELLED} labelled alerts are needed, got {rows}")
    if len(cuts) < 2:
        raise ValueError("labelled alerts must hold both verdicts")
    moments = known.agg(*[F.avg(c) for c in SCORE_COLUMNS], *[F.stddev_pop(c) for c in SCORE_COLUMNS]).first()
    size = len(SCORE_COLUMNS)
    mean, deviation = np.array(moments[:size]), np.array([v or 1.0 for v in moments[size:]])

    cut = F.when(F.col("confirmado") == 1, F.lit(cuts[1][0])).otherwise(F.lit(cuts[0][0]))
    z = [column.alias(f"z{k}") for k, column in enumerate(_standardised(mean, deviation))]
    train = known.where(F.col("_lot") > cut).select(F.col("confirmado").cast("double").alias("y"), *z)
    weights = _newton(materialise(train, "calibration-train"), inverse_penalty)
    fitted = Calibrator(weights[:-1], mean, deviation, float(weights[-1]), float("nan"), rows)
    held = apply_calibrator(fitted, known.where(F.col("_lot") <= cut))
    auc = BinaryClassificationEvaluator(labelCol="confirmado", rawPredictionCol="prob_confirmacao").evaluate(held)
    return Calibrator(fitted.weights, mean, deviation, fitted.intercept, float(auc), rows)


def apply_calibrator(calibrator: Calibrator, scores: DataFrame) -> DataFrame:
    """`scores` with prob_confirmacao, the calibrated probability of confirmation: one column expression."""
    z = _standardised(calibrator.mean, calibrator.deviation)
    odds = _odds(z, np.append(calibrator.weights, calibrator.intercept))
    return scores.withColumn("prob_confirmacao", 1 / (1 + F.exp(-odds)))
