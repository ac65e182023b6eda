"""Centroid clustering of fixed-point vectors; Ptolemaic pivot bounds spare exact distances.

* Vectors are turned into integers once and written with their distances to a few fixed pivots.
* Every round is one pass: the centroids (k rows) are shared, and for a vector x, a centroid c and a
  pivot pair p, s Ptolemy's inequality gives ``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``
  from the cached distances.  The centroid of the least bound is measured exactly; all whose bound, rounded
  down, isn't above that distance are measured exactly as well, and the nearest wins (ties: the
  smaller number).  All decisions fall on exact integers.
* A task returns one sum for each centroid and component; sums are exact decimals, and k rows of
  floor(sum / count) come back for the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.vectors import EXACT_FLOAT, LONG, fixed_point, lists, matrix, most
from cinerank.session import materialize

DIM = 64
K = 40
ROUNDS = 5
SCALE = 256
SALT = 2
PIVOTS = 6
BLOCK = 8192


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one vector c, or to as many rows of c."""
    if x.shape[-1] * (most(x) + most(c)) ** 2 > LONG:
        raise ArithmeticError("squared distances leave 64 bits")
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def squared_all(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of x by rows of c."""
    if x.shape[1] * (most(x) + most(c)) ** 2 < EXACT_FLOAT:
        fx, fc = x.astype(np.float64), c.astype(np.float64)
        return ((fx * fx).sum(axis=1)[:, None] + (fc * fc).sum(axis=1) - 2 * (fx @ fc.T)).astype(np.int64)
    return np.stack([squared(x, row) for row in c], axis=1)


class Pivots:
    """Fixed pivots and the bounds that they give."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        apart = np.sqrt(squared_all(points, points).astype(np.float64)) if len(points) else np.zeros((0, 0))
        self.pairs = [(p, s, apart[p, s]) for p in range(len(points)) for s in range(p) if apart[p, s] > 0]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(squared_all(x, self.points).astype(np.float64)) if len(self.points) else np.zeros((len(x), 0))

    def bounds(self, dx: np.ndarray, dc: np.ndarray) -> np.ndarray:
        """Rows x centroids: not above the true distance, whatever was rounded."""
        out = np.zeros((len(dx), len(dc)))
        for p, s, apart in self.pairs:
            one, two = np.outer(dx[:, p], dc[:, s]), np.outer(dx[:, s], dc[:, p])
            np.maximum(out, (np.abs(one - two) - 1e-12 * (one + two)) / (apart * (1 + 1e-12)), out=out)
        return out * (1 - 1e-12)


def assign(x: np.ndarray, dx: np.ndarray, centers: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centre, exact squared distance, exact distances taken) of every row."""
    bound = pivots.bounds(dx, pivots.distances(centers))
    near = bound.argmin(axis=1)
    best = squared(x, centers[near])
    taken = len(x)
    left = bound <= (np.sqrt(best.astype(np.float64)) * (1 + 1e-12) + 1e-9)[:, None]
    left[np.arange(len(x)), near] = False
    for c in range(len(centers)):
        own = np.flatnonzero(left[:, c])
        if len(own):
            d = squared_all(x if len(own) == len(x) else x[own], centers[c:c + 1])[:, 0]
            closer = (d < best[own]) | ((d == best[own]) & (c < near[own]))
            near[own[closer]], best[own[closer]] = c, d[closer]
            taken += len(own)
    return near, best, taken


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, pivots: int):
    """(whole batch slice, matrix, pivot distances)."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            b = whole.slice(at, BLOCK)
            d = b.column("d").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, pivots)
            yield b, matrix(b.column("x"), dim), d


def digest(center: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, center.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, *, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: int = SALT,
            pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors with exactly ``dim`` components, none null or non-finite; components count as
    floor(scale * x).  Centroids start as the ``k`` kept vectors with the smallest sha256 of
    ``<salt>:<vec_id>`` in that order (equal ids: the smaller vector first); each of ``rounds`` rounds
    assigns all vectors and moves every non-empty centroid to the componentwise floor(sum / count);
    then vectors are assigned once more.  With fewer than ``k`` vectors there are as many centroids.

    A null id is kept and assigned, but never starts a centroid; if all ids are null there are no
    centroids and no rows.  Repeated rows count each.  Other columns are ignored; an empty table gives no
    rows.  A distance beyond 64 bits raises ArithmeticError.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.size("v") == dim)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, x = fixed_point(b.column(1), scale, dim)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())), lists(x)], names=["vec_id", "x"])

    kept = rows.mapInArrow(whole, "vec_id long, x array<long>")
    start = kept.filter(F.col("vec_id").isNotNull()).orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256), "x") \
        .limit(k).toArrow()  # k rows
    centers = matrix(start.column("x"), dim)
    if not len(centers):
        return spark.createDataFrame([], schema)
    fixed = Pivots(np.unique(centers, axis=0)[:pivots])
    shared = spark.sparkContext.broadcast(fixed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = shared.value.distances(matrix(b.column("x"), dim))
            at = pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(at, pa.array(d.ravel()))], names=["vec_id", "x", "d"])

    cached = materialize(kept.mapInArrow(measure, "vec_id long, x array<long>, d array<double>"), "cluster-vectors")
    n_pivots = len(fixed.points)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(centers)
        sums = cached.select("x", "d").mapInArrow(_sums(shared, now, dim, n_pivots), "cluster int, dim int, total long, n long") \
            .groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")) \
            .collect()  # k x dim rows
        now.unpersist()
        centers = centers.copy()
        for r in sums:
            centers[r.cluster, r.dim] = int(r.total) // r.n
    last = spark.sparkContext.broadcast(centers)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x, d in _blocks(batches, dim, n_pivots):
            near, best, _ = assign(x, d, last.value, shared.value)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(near, pa.int32()), pa.array(best, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    placed = materialize(cached.mapInArrow(place, "vec_id long, cluster int, distance long"), "cluster-placed")
    per = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    whole_sum = sum(r.cluster_inertia for r in per)
    facts = spark.createDataFrame([(r.cluster, r.cluster_inertia, whole_sum, digest(centers[r.cluster])) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sums(pivots, centers, dim: int, n_pivots: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centers.value)
        total, n = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, x, d in _blocks(batches, dim, n_pivots):
            near, _, _ = assign(x, d, centers.value, pivots.value)
            order = np.argsort(near, kind="stable")
            own, first = np.unique(near[order], return_index=True)
            total[own] += np.add.reduceat(x[order], first, axis=0)
            n += np.bincount(near, minlength=k)
        c, at = np.nonzero(np.repeat(n[:, None] > 0, dim, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(at, pa.int32()), pa.array(total[c, at]), pa.array(n[c])],
                                         names=["cluster", "dim", "total", "n"])

    return sums
