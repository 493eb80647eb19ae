"""Rule M1: isolation forest (Liu, Ting & Zhou, 2008) as Spark jobs, one forest or one per group of rows.

Every draw is a digest of (seed, group, tree, node or row), so a forest depends on nothing but its rows and can be
recomputed elsewhere bit by bit. Training takes a bounded pool of rows by hash, deals a sample of it to each tree,
and grows each tree in its own small group; the model is a bounded table of nodes. Scoring walks all trees over
Arrow batches. Standardising features is left out: random axis-parallel cuts do not depend on scale.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.functions.quantiles import exact_quantiles
from txwatch.operators.features import FEATURE_COLUMNS

TREES = 200
SAMPLE = 256
#: Rows of a group from which its trees draw their samples.
POOL = 64 * SAMPLE
#: Group of the rows without a group and of groups too small for a forest of their own.
REST = "*"
#: Features count to this many places: no cut is drawn between values that differ by rounding alone.
PLACES = 6
#: Path lengths are added up in units of 1e-9, so that a score does not depend on the order of trees.
UNIT = 1e9
NODE_SCHEMA = (
    "grupo string, arvore int, no int, coluna int, corte double, esquerda int, direita int, "
    "tamanho int, profundidade int"
)
_EULER = 0.5772156649015329
_TOP = 2.0**60


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def _draw(*parts: Column | str) -> Column:
    """A number below 2**60: the first 15 hexadecimal digits of the MD5 of the parts."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def with_group(features: DataFrame, group: str | None = None, min_rows: int = SAMPLE) -> DataFrame:
    """`features` with `grupo`: the value of the column `group`, or REST where that is null or has fewer than
    `min_rows` rows. Without a column all rows are one group, the empty text. Values must be few: forests and
    statistics of all groups are broadcast."""
    if group is None:
        return features.withColumn("grupo", F.lit(""))
    sizes = features.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    large = sizes.select(F.col(group).alias("_large")).where("_large is not null")
    marked = features.join(F.broadcast(large), F.col(group) == F.col("_large"), "left")
    return marked.withColumn("grupo", F.coalesce(F.col("_large").cast("string"), F.lit(REST))).drop("_large")


def _lowest(rows: DataFrame, keys: list[str], draw: Column, k: int) -> DataFrame:
    """The k rows of each group with the smallest draws, ties by id.

    A group's size is counted first; then a row goes on only if its draw is below twice the share wanted, so
    the ranking sees about 2 k rows a group. Fewer than k get that far with a chance below 1e-12.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    near = rows.withColumn("_draw", draw).join(F.broadcast(sizes), keys)
    near = near.where(F.col("_draw") < F.least(F.lit(1.0), F.lit(2.0 * k) / F.col("_n")) * F.lit(_TOP))
    order = Window.partitionBy(*keys).orderBy("_draw", "transacao_id")
    ranked = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    return ranked.drop("_n", "_draw", "_place")


def sample_rows(features: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """min(sample, rows) rows of its group's pool for every tree. `features` has `grupo` and an id; nothing is
    counted while the plan is built."""
    pool = _lowest(features, ["grupo"], _draw(str(seed), F.col("transacao_id")), POOL * max(1, sample // SAMPLE))
    dealt = pool.withColumn("arvore", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    chosen = _draw(str(seed), F.col("arvore"), F.col("transacao_id"))
    return _lowest(dealt, ["grupo", "arvore"], chosen, sample)


def grow_forest(
    features: DataFrame,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = 42,
    columns: tuple[str, ...] = FEATURE_COLUMNS,
    group: str | None = None,
) -> DataFrame:
    """Node table of the forest, at most trees x (2 x sample - 1) rows for each group.

    Nodes are numbered as in a heap: 1 is the root, 2 n and 2 n + 1 the children of n.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("transacao_id")[list(columns)].to_numpy(dtype=float)
        return _grow_tree(x, pdf["grupo"].iloc[0], int(pdf["arvore"].iloc[0]), seed)

    rounded = [F.round(F.col(c).cast("double"), PLACES).alias(c) for c in columns]
    rows = with_group(features, group, sample).select("grupo", "transacao_id", *rounded)
    return sample_rows(rows, trees, sample, seed).groupBy("grupo", "arvore").applyInPandas(grow, NODE_SCHEMA)


def _grow_tree(x: np.ndarray, group: str, tree: int, seed: int) -> pd.DataFrame:
    """At each node the digest's first 8 hexadecimal digits choose a column, the next 13 a place between its ends."""
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[tuple] = []
    waiting = [(1, 0, np.arange(len(x)))]
    while waiting:
        me, depth, members = waiting.pop()
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or not len(usable):
            nodes.append((group, tree, me, -1, 0.0, -1, -1, len(members), depth))
            continue
        digest = md5(f"{seed}:{group}:{tree}:{me}".encode()).hexdigest()
        column = int(usable[int(digest[:8], 16) % len(usable)])
        cut = float(low[column] + int(digest[8:21], 16) / 2.0**52 * (high[column] - low[column]))
        if cut >= high[column]:
            cut = float(low[column])
        goes_left = x[members, column] <= cut
        nodes.append((group, tree, me, column, cut, 2 * me, 2 * me + 1, len(members), depth))
        waiting += [(2 * me, depth + 1, members[goes_left]), (2 * me + 1, depth + 1, members[~goes_left])]
    return pd.DataFrame(nodes, columns=[part.split()[0] for part in NODE_SCHEMA.split(", ")])


class _Forest:
    """Node arrays of all trees laid end to end, plus the vectorised walk."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["arvore", "no"])
        tree, number = nodes["arvore"].to_numpy(np.int64), nodes["no"].to_numpy(np.int64)
        names = (tree << 32) + number
        inner = nodes["coluna"].to_numpy() >= 0
        here = np.arange(len(nodes))
        # Children sit side by side, left then right. A leaf leads to itself, so every walk can take
        # the same number of steps.
        sides = [nodes[side].to_numpy(np.int64) for side in ("esquerda", "direita")]
        found = [np.where(inner, np.searchsorted(names, (tree << 32) + child), here) for child in sides]
        self.children = np.stack(found, axis=1).ravel().astype(np.int32)
        self.column = np.where(inner, nodes["coluna"].to_numpy(), 0).astype(np.int32)
        self.cut = nodes["corte"].to_numpy(dtype=float)
        self.depths = nodes.groupby("arvore")["profundidade"].max().to_numpy()
        self.roots = np.flatnonzero(number == 1)
        ends = nodes["profundidade"].to_numpy() + [average_path(n) for n in nodes["tamanho"]]
        self.length = np.where(inner, 0, np.rint(ends * UNIT)).astype(np.int64)
        size = int(nodes["tamanho"].to_numpy()[self.roots].max())
        self.scale = max(len(self.roots) * average_path(size), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        flat, rows = np.ascontiguousarray(x).ravel(), np.arange(len(x), dtype=np.int32) * x.shape[1]
        total = np.zeros(len(x), dtype=np.int64)
        for root, depth in zip(self.roots, self.depths):
            at = np.full(len(x), root, dtype=np.int32)
            for _ in range(depth):
                goes_right = flat.take(rows + self.column.take(at)) > self.cut.take(at)
                at = self.children.take(2 * at + goes_right)
            total += self.length.take(at)
        return np.power(2.0, -(total / UNIT) / self.scale)


def forest_scores(
    features: DataFrame,
    nodes: DataFrame,
    columns: tuple[str, ...] = FEATURE_COLUMNS,
    group: str | None = None,
) -> DataFrame:
    """transacao_id, grupo and the raw anomaly score in (0, 1] by the forest of the row's group.

    A row whose group has no forest is scored by that of REST, or has no score where there is none. Only the
    node table, whose size is fixed by the forests, travels through the driver.
    """
    table = nodes.toPandas()
    forests = {name: _Forest(part) for name, part in table.groupby("grupo")}
    shared = features.sparkSession.sparkContext.broadcast(forests)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            x = pdf[list(columns)].to_numpy(dtype=float)
            names = pdf["grupo"].where(pdf["grupo"].isin(list(known)), REST).to_numpy()
            raw = np.full(len(pdf), np.nan)
            for name in set(names) & set(known):
                some = names == name
                raw[some] = known[name].score(x[some])
            score = pd.Series(raw, dtype=object).where(~np.isnan(raw), None)
            yield pd.DataFrame({"transacao_id": pdf["transacao_id"], "grupo": names, "bruto": score})

    own = F.lit("") if group is None else F.coalesce(F.col(group).cast("string"), F.lit(REST))
    rounded = [F.round(F.col(c).cast("double"), PLACES).alias(c) for c in columns]
    kept = features.select("transacao_id", own.alias("grupo"), *rounded)
    return kept.mapInPandas(walk, "transacao_id string, grupo string, bruto double")


def normalise(raw: DataFrame) -> DataFrame:
    """Rule M1: scores stretched to 0..1 over the scored batch of each group; its top percentile alerts.

    Without a column `grupo` the batch is one group. `raw` is read several times and should be a stored table.
    """
    keys = [c for c in ("grupo",) if c in raw.columns]
    span = raw.groupBy(*keys).agg(F.min("bruto").alias("_min"), F.max("bruto").alias("_max"))
    top = exact_quantiles(raw, "bruto", [0.99], tuple(keys)).select(*keys, F.col("quantil").alias("_p99"))
    width = F.greatest(F.col("_max") - F.col("_min"), F.lit(1e-9))
    alert = F.col("bruto") >= F.col("_p99")
    text = F.lit("Isolation Forest: padrão multivariado anômalo")
    known = raw.where(F.col("bruto").isNotNull())
    if keys:
        scored = known.join(F.broadcast(span), keys).join(F.broadcast(top), keys)
    else:
        scored = known.crossJoin(F.broadcast(span)).crossJoin(F.broadcast(top))
    return scored.withColumn("alerta", alert).select(
        *keys,
        "transacao_id",
        F.lit("M1_ISOLATION_FOREST").alias("regra_id"),
        F.lit("FRAUDE").alias("familia"),
        "alerta",
        ((F.col("bruto") - F.col("_min")) / width).alias("score"),
        F.when(F.col("alerta"), text).alias("motivo"),
    )
