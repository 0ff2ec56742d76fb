"""Centroid clustering with Ptolemaic pivots.

For any vector x, centroid c and pivots p, s, Ptolemy's inequality gives
``|x-c| |p-s| >= | |x-p| |c-s| - |x-s| |c-p| |``. The distances of every vector to a few fixed pivots are
computed once and kept beside it; a round adds the distances of the centroids to the pivots, bounds every
distance from below, and computes exactly only those that the bounds leave open. Bounds are floating point
and lowered by more than their rounding can be; vectors and centroids are integers, so what decides is
exact and does not depend on how rows are spread.

A round is one read of the written vectors. What leaves a task is one count and one sum per centroid and
component; the driver holds the centroids, whose number is a parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from ._vectors import integers, mean_floor, packed, squared, unpacked, usable

CENTROIDS, ROUNDS, DIMS, FACTOR = 40, 5, 64, 256
PIVOTS = 6
# Vectors that are compared with all centroids at once.
PART = 1024
# Rounding of distances and bounds stays far below this share of the terms.
ROUNDING = 2.0 ** -44


@dataclass(frozen=True)
class Pivots:
    """Fixed vectors, pairs of them and the distance within each pair."""

    points: np.ndarray
    pairs: tuple[tuple[int, int, float], ...]

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([np.sqrt(squared(vectors, p[None, :]).astype(np.float64)) for p in self.points],
                        axis=1) if len(self.points) else np.zeros((len(vectors), 0))

    def lower_bounds(self, far: np.ndarray, centroids_far: np.ndarray) -> np.ndarray:
        """Never above the true distance of any vector (row) to any centroid (column)."""
        best = np.zeros((len(far), len(centroids_far)))
        for p, s, apart in self.pairs:
            one = np.outer(far[:, p], centroids_far[:, s])
            other = np.outer(far[:, s], centroids_far[:, p])
            bound = (np.abs(one - other) - ROUNDING * (one + other)) / apart * (1 - ROUNDING)
            np.maximum(best, bound, out=best)
        return best


def choose_pivots(start: np.ndarray, count: int = PIVOTS) -> Pivots:
    """Pivots far from each other among the start vectors, and all pairs of them."""
    if not len(start):
        return Pivots(start, ())
    chosen = [0]
    nearest = squared(start, start[:1])
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(start, start[chosen[-1]][None, :]))
    points = start[chosen]
    pairs = tuple((p, s, float(np.sqrt(float(squared(points[p:p + 1], points[s:s + 1])[0]))))
                  for p in range(len(points)) for s in range(p + 1, len(points)))
    return Pivots(points, pairs)


def nearest_centroids(vectors: np.ndarray, far: np.ndarray, centroids: np.ndarray,
                      pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), its squared distance, and how many were computed."""
    bounds = pivots.lower_bounds(far, pivots.distances(centroids))
    guess = bounds.argmin(axis=1)
    reached = squared(vectors, centroids[guess])
    limit = np.sqrt(reached.astype(np.float64)) * (1 + ROUNDING)
    row, column = np.nonzero(bounds <= limit[:, None])
    exact = np.full(bounds.shape, np.iinfo(np.int64).max)
    exact[row, column] = squared(vectors[row], centroids[column])
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(vectors)), best], len(row) + len(vectors)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)


def start_vectors(vectors: DataFrame, key: str, hashed: Column, count: int, factor: int,
                  dims: int) -> np.ndarray:
    """The vectors with the smallest hash, as integers; equal hashes follow the components."""
    rows = (vectors.select(hashed.alias("_hash"), F.col(key).alias("_key"), "_v")
            .orderBy(F.col("_hash").asc_nulls_last(), "_v").limit(count).collect())
    column = pa.array([r["_v"] for r in rows], pa.list_(pa.float64()))
    return integers(column, dims, factor)


def cluster(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
            centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, factor: int = FACTOR,
            seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """``key, cluster, distance`` of every usable vector after ``rounds`` updates, and the centroids.

    Vectors that are null, have another length than ``dims`` or a component that is no finite number are
    left out; the others become ``floor(factor * x)``. The start is the vectors with the smallest SHA-256
    of ``seed:key``; fewer vectors than ``centroids`` give fewer centroids, none give no rows. Centroids
    without vectors stay. Repeated rows each count, and of rows with one key those with smaller components
    start first. A row without a key is clustered but starts only if there are too few others. Other
    columns are not read. Components too large for exact 64-bit distances are an error.
    """
    v = F.col(embedding).cast("array<double>")
    kind = vectors.schema[key].dataType.simpleString()
    kept = vectors.select(F.col(key), v.alias("_v")).filter(
        (F.coalesce(F.size("_v"), F.lit(-1)) == dims) & usable(F.col("_v")))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    now = start_vectors(kept, key, hashed, centroids, factor, dims)
    pivots = choose_pivots(now)
    n_pivots = len(pivots.points)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows = integers(part.column(1), dims, factor)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), packed(rows, "<i4"), packed(pivots.distances(rows), "<f8")],
                names=[key, "v", "far"])

    written = stage(kept.mapInArrow(prepare, f"`{key}` {kind}, v binary, far binary"), "vectors")

    def assigned(part: pa.RecordBatch, centres: np.ndarray):
        rows = unpacked(part.column("v"), dims, "<i4").astype(np.int64)
        far = unpacked(part.column("far"), n_pivots, "<f8") if n_pivots else np.zeros((len(rows), 0))
        return rows, *nearest_centroids(rows, far, centres, pivots)[:2]

    def sums_of(centres: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros_like(centres), np.zeros(len(centres), dtype=np.int64)
            for part in _parts(batches):
                rows, best, _ = assigned(part, centres)
                np.add.at(sums, best, rows)
                counts += np.bincount(best, minlength=len(centres))
            filled = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(filled, dims), pa.int32()),
                 pa.array(np.tile(np.arange(dims), len(filled)), pa.int32()),
                 pa.array(np.repeat(counts[filled], dims), pa.int64()),
                 pa.array(sums[filled].ravel(), pa.int64())], names=["cluster", "place", "rows", "total"])
        return work

    for _ in range(rounds if len(now) else 0):
        partial = written.select("v", "far").mapInArrow(
            sums_of(now), "cluster int, place int, rows long, total long")
        total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        now = now.copy()
        for r in partial.groupBy("cluster", "place").agg(F.sum("rows").alias("rows"), total).collect():
            now[r["cluster"], r["place"]] = mean_floor(r["total"], r["rows"])

    final = now

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            _, best, apart = assigned(part, final)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(best, pa.int32()), pa.array(apart, pa.int64())],
                names=[key, "cluster", "distance"])

    found = written.mapInArrow(label, f"`{key}` {kind}, cluster int, distance long")
    return stage(found, "clusters"), final


def inertia_table(vectors: DataFrame, key: str = "vec_id", **settings) -> DataFrame:
    """Clusters with ``cluster_inertia``, ``inertia`` and the SHA-256 of each row's final centroid."""
    found, centroids = cluster(vectors, key, **settings)
    spark = vectors.sparkSession
    summed = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    rows = [(number, total, sum(summed.values()),
             hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
            for number, total in sorted(summed.items())]
    # One row per centroid, whose number is a parameter.
    per_cluster = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per_cluster), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
