"""Rule M2: dense autoencoder over monthly member profiles, trained data-parallel.

Each round sends the weights to every partition, which runs mini-batch Adam over its own rows; the
weights and moments are then averaged, weighted by rows, in a Spark aggregate. Only that fixed-size
state (three times the number of weights) passes through the driver. With one partition this is
ordinary mini-batch training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.operators.facts import PROFILE_COLUMNS
from txwatch.session import materialise

# Layer widths between input and output.
HIDDEN = (16, 8, 16)
_KEYS = ["associado_id", "ano_mes"]
_BETA1, _BETA2, _TINY = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class AutoencoderModel:
    weights: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    threshold: float
    #: Per round: epochs done, mean training loss, mean loss on the held-out fifth.
    history: list[tuple[int, float, float]]
    columns: tuple[str, ...] = PROFILE_COLUMNS

    def standardise(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.deviation


def _shapes(inputs: int) -> list[tuple[int, int]]:
    widths = (inputs, *HIDDEN, inputs)
    return list(zip(widths[:-1], widths[1:]))


def _layers(flat: np.ndarray, inputs: int) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for rows, cols in _shapes(inputs):
        kernel = flat[at : at + rows * cols].reshape(rows, cols)
        at += rows * cols
        layers.append((kernel, flat[at : at + cols]))
        at += cols
    return layers


def initial_weights(inputs: int, seed: int) -> np.ndarray:
    """Uniform within 1 / sqrt(inputs of the layer): 52 bits of the MD5 of seed and place for each number."""
    bounds = np.concatenate([np.full(rows * cols + cols, 1.0 / np.sqrt(rows)) for rows, cols in _shapes(inputs)])
    draws = [int(md5(f"{seed}:{place}".encode()).hexdigest()[:13], 16) / 2.0**52 for place in range(len(bounds))]
    return bounds * (2.0 * np.array(draws) - 1.0)


def reconstruct(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    layers = _layers(flat, x.shape[1])
    for kernel, bias in layers[:2]:
        x = np.maximum(x @ kernel + bias, 0.0)
    kernel, bias = layers[2]
    x = np.maximum(x @ kernel + bias, 0.0)
    kernel, bias = layers[3]
    return x @ kernel + bias


def loss_and_gradient(flat: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
    layers = _layers(flat, x.shape[1])
    seen = [x]
    for depth, (kernel, bias) in enumerate(layers):
        out = seen[-1] @ kernel + bias
        seen.append(out if depth == len(layers) - 1 else np.maximum(out, 0.0))
    gap = seen[-1] - x
    slope = 2.0 * gap / gap.size
    parts: list[np.ndarray] = []
    for depth in range(len(layers) - 1, -1, -1):
        kernel, _ = layers[depth]
        parts.insert(0, np.concatenate([(seen[depth].T @ slope).ravel(), slope.sum(axis=0)]))
        if depth:
            slope = (slope @ kernel.T) * (seen[depth] > 0)
    return float(np.mean(gap * gap)), np.concatenate(parts)


def train_autoencoder(
    profile: DataFrame,
    epochs: int = 40,
    epochs_per_round: int = 5,
    batch_size: int = 256,
    rate: float = 1e-3,
    seed: int = 42,
    rows_per_shard: int = 50_000,
) -> AutoencoderModel:
    """Fit on four fifths of the profiles (chosen by key hash); the threshold is the 99th percentile
    of the reconstruction error on the rest. `profile` is read twice and should be a stored table.

    The update is the same at every size: `epochs_per_round` epochs on every shard, then the average of
    the shards' states; a single shard is its own average. With `epochs` 0 the network keeps its starting weights.
    """
    columns = list(PROFILE_COLUMNS)
    moments = profile.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    if not moments["n"]:
        raise ValueError("no profiles to train on")
    mean = np.array([moments[f"m_{c}"] for c in columns])
    deviation = np.array([moments[f"s_{c}"] or 1.0 for c in columns])

    # One in five keys is held out, by a digest that other systems can repeat.
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *_KEYS).cast("binary"))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 5
    shards = max(1, -(-int(moments["n"]) // rows_per_shard))
    train = (
        profile.where(part != 0)
        .select(*_KEYS, *[F.col(c).cast("double").alias(c) for c in columns])
        .repartition(shards, *_KEYS)
        .sortWithinPartitions(*_KEYS)
        .select(*columns)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    held_rows = profile.where(part == 0).persist(StorageLevel.MEMORY_AND_DISK)
    inputs = len(columns)
    flat = initial_weights(inputs, seed)
    state = np.concatenate([flat, np.zeros(2 * len(flat))])
    history, done = [], 0
    try:
        while done < epochs:
            run = min(epochs_per_round, epochs - done)
            state, loss = _round(
                train, state, mean, deviation, done, run, batch_size, rate, seed
            )
            done += run
            history.append((done, loss, _held_loss(held_rows, state[: len(flat)], mean, deviation)))
    finally:
        train.unpersist()
        held_rows.unpersist()

    weights = state[: len(flat)]
    fitted = AutoencoderModel(weights, mean, deviation, float("nan"), history)
    held = materialise(reconstruction_error(profile.where(part == 0), fitted), "held-errors")
    rows = exact_quantiles(held, "erro", [0.99]).collect()
    threshold = rows[0]["quantil"] if rows else float("inf")
    return AutoencoderModel(weights, mean, deviation, float(threshold), history)


def _round(
    train: DataFrame,
    state: np.ndarray,
    mean: np.ndarray,
    deviation: np.ndarray,
    done: int,
    run: int,
    batch_size: int,
    rate: float,
    seed: int,
) -> tuple[np.ndarray, float]:
    size = len(state) // 3

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = [(b.to_numpy(dtype=float) - mean) / deviation for b in batches]
        if not blocks:
            return
        x = np.concatenate(blocks)
        flat, first, second = (state[i * size : (i + 1) * size].copy() for i in range(3))
        per_epoch = -(-len(x) // batch_size)
        step, loss = done * per_epoch, 0.0
        for epoch in range(run):
            order = np.random.default_rng([seed, done + epoch]).permutation(len(x))
            loss = 0.0
            for at in range(0, len(x), batch_size):
                batch = x[order[at : at + batch_size]]
                value, slope = loss_and_gradient(flat, batch)
                step += 1
                first = _BETA1 * first + (1 - _BETA1) * slope
                second = _BETA2 * second + (1 - _BETA2) * slope * slope
                unbiased = second / (1 - _BETA2**step)
                flat = flat - rate * first / (1 - _BETA1**step) / (np.sqrt(unbiased) + _TINY)
                loss += value * len(batch)
        out = np.concatenate([flat, first, second, [loss / len(x)]])
        yield pd.DataFrame({"posicao": np.arange(len(out)), "valor": out, "n": len(x)})

    local_states = train.mapInPandas(local, "posicao long, valor double, n long")
    merged = local_states.groupBy("posicao").agg(
        (F.sum(F.col("valor") * F.col("n")) / F.sum("n")).alias("valor")
    )
    # len(state) + 1 numbers, whatever the volume of data.
    rows = merged.collect()
    out = np.concatenate([state, [float("nan")]])
    for row in rows:
        out[row["posicao"]] = row["valor"]
    return out[:-1], float(out[-1])


def _held_loss(held: DataFrame, weights: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> float:
    """Mean reconstruction error, NaN without rows."""
    now = AutoencoderModel(weights, mean, deviation, float("nan"), [])
    loss = reconstruction_error(held, now).agg(F.avg("erro")).first()[0]
    return float("nan") if loss is None else float(loss)


def reconstruction_error(profile: DataFrame, model: AutoencoderModel) -> DataFrame:
    """associado_id, ano_mes, erro (mean squared error of the standardised profile)."""
    columns = list(model.columns)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = model.standardise(pdf[columns].to_numpy(dtype=float))
            gap = reconstruct(model.weights, x) - x
            yield pdf[_KEYS].assign(erro=np.mean(gap * gap, axis=1))

    kept = profile.select(*_KEYS, *columns)
    return kept.mapInPandas(measure, "associado_id string, ano_mes string, erro double")


def error_findings(errors: DataFrame, threshold: float) -> DataFrame:
    """Rule M2: one finding per member and month from its reconstruction error."""
    alert = F.col("erro") > F.lit(threshold)
    score = F.col("erro") / F.greatest(F.lit(threshold) * 2, F.lit(1e-9))
    text = F.lit("Autoencoder: erro de reconstrução acima do p99")
    return errors.withColumn("alerta", alert).select(
        *_KEYS,
        F.lit("M2_AUTOENCODER").alias("regra_id"),
        F.lit("FRAUDE").alias("familia"),
        "alerta",
        F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"),
        F.when(F.col("alerta"), text).alias("motivo"),
    )


def autoencoder_findings(profile: DataFrame, model: AutoencoderModel) -> DataFrame:
    return error_findings(reconstruction_error(profile, model), model.threshold)
