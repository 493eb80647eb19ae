"""Centroid clustering in integers, with the nearest centroid found by a bisector tournament.

For centroids i < j a vector x lies nearer to j exactly when 2 (c_j - c_i) . x > |c_j|^2 - |c_i|^2. These integer
normals and thresholds are computed once a round for all pairs. A vector's current winner then meets the
remaining centroids in the order of their numbers: k - 1 linear sign tests, where zero favours the smaller number.
No distance is computed before the last assignment, and that one is exact.

A round is one map over the vectors with map-side totals: every task yields at most k rows (sums and a count per
cluster), so vectors are never shuffled, and a cluster that holds most of them is no hot group. Only k centroids
of fixed width pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.session import materialise

#: Components of this size and below give squared distances and tests that fit 64 bits at up to 64 components.
LIMIT = 1 << 26


def quantised(vectors: DataFrame, width: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, x): vectors of exactly `width` finite components as integers floor(scale * component).

    Shorter, longer and null vectors, and those with a null or non-finite component, are left out. A component
    beyond LIMIT after scaling ends the job with an error that names it: distances would not fit their type.
    """
    finite = F.forall(F.col("embedding"), lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    x = F.transform(F.col("embedding"), lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    whole = F.when(
        F.forall(x, lambda v: F.abs(v) <= LIMIT), F.transform(x, lambda v: v.cast("int"))
    ).otherwise(F.raise_error(F.lit(f"a component exceeds {LIMIT} after scaling")).cast("array<int>"))
    return vectors.where((F.size("embedding") == width) & finite).select("vec_id", whole.alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:vec_id`, in the order of these hashes.

    Ties (repeated vec_ids) go by the components; null vec_ids come last.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(digest.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        best = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", x, self.normals[best, j])
            best[side > self.thresholds[best, j]] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return np.einsum("ij,ij->i", apart, apart)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _totals(centroids: np.ndarray):
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Tournament(centroids)
        sums, counts = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, width)
            best = test.winners(x)
            counts += np.bincount(best, minlength=k)
            for c in range(k):
                sums[c] += x[best == c].sum(axis=0)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(counts[found]), pa.array(list(sums[found]), pa.list_(pa.int64()))],
            ["cluster", "n", "s"],
        )

    return run


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the componentwise floor of its vectors' mean."""
    width = centroids.shape[1]
    part = kept.select("x").mapInArrow(_totals(centroids), "cluster int, n long, s array<long>")
    # Totals of all tasks as decimals: they do not overflow.
    total = part.groupBy("cluster").agg(
        F.sum(F.col("n").cast("decimal(20,0)")).alias("n"),
        F.array(*[F.sum(F.col("s")[c].cast("decimal(20,0)")) for c in range(width)]).alias("s"),
    )
    after = centroids.copy()
    for row in total.collect():  # at most k rows
        after[row["cluster"]] = [int(v) // int(row["n"]) for v in row["s"]]
    return after


def _assigned(centroids: np.ndarray, id_type: pa.DataType | None = None):
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Tournament(centroids)
        for batch in batches:
            x = _matrix(batch, width)
            best = test.winners(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(test.distances(x, best))],
                ["vec_id", "cluster", "distance"],
            )

    return run


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, width: int = 64, scale: int = 1024
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) per kept vector of `vectors` (vec_id, embedding), and the final centroids.

    Distances are squared and exact. With fewer than k kept vectors there are as many centroids; equal centroids
    leave the larger number empty, and empty centroids stay where they are. Repeated rows count as often as they
    occur. Without kept vectors the table is empty. Other columns are not read.
    """
    kept = materialise(quantised(vectors, width, scale), "centroid-vectors")
    centroids = first_centroids(kept, k, seed)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return kept.selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    found = kept.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance long")
    return materialise(found, "centroid-assignment"), centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the inertia of each row's cluster and of all, and the digest of its centroid."""
    session = found.sparkSession
    if not len(centroids):
        return found.selectExpr("*", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256")
    each = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    about = session.createDataFrame(
        [
            (c, each.get(c, 0), sum(each.values()), sha256(",".join(map(str, row)).encode()).hexdigest())
            for c, row in enumerate(centroids.tolist())
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(about), "cluster")  # k rows
