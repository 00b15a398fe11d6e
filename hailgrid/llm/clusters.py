"""Lloyd's clustering in whole numbers, with a LAESA pivot table in front of the distances.

Vectors are rounded to integers, so distances, sums and means are exact and a
result does not depend on how rows are dealt. The pivot table holds, for every
vector, the distances to a few fixed pivots; it is computed and written once.
In each round the distances of the centroids to the pivots are known too, and
by the triangle inequality the largest difference of the two is a lower bound
of the distance between vector and centroid. The centroid with the least bound
is measured first; a centroid whose bound exceeds that distance cannot be
nearest and is left out; all others get their exact distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.llm.scratch import stored

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
PIVOTS = 12
#: Vectors that pivots are chosen from: the first in order of their hash.
PIVOT_POOL = 256
#: Components are held within this bound, so that a squared distance fits in a long.
LIMIT = 1 << 27
LONGEST = (1 << 63) - 1
#: Relative slack for the rounding of floating-point distances; a bound within it discards nothing.
SLACK = 1e-9


def id_hash(seed: int) -> Column:
    """Lowercase hex sha256 of ``seed:vec_id``."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``vector``, floor(scale * x) of every component, of the rows that have all components."""
    finite = F.forall("x", lambda v: F.abs(v) < float("inf"))  # NaN is larger, null is neither
    # the limit comes before the rounding: beyond it there may be no whole number to round to
    held = lambda v: F.least(F.lit(float(LIMIT)), F.greatest(F.lit(float(-LIMIT)), v * F.lit(float(scale))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    kept = rows.filter(F.size("x") == dimensions).filter(finite)
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(held(v)).cast("int")).alias("vector"))


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number vectors to one point."""
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


def far_apart(pool: np.ndarray, count: int) -> np.ndarray:
    """The first vector, then always the one farthest from those chosen."""
    chosen = [0]
    least = squared(pool, pool[0])
    while len(chosen) < count and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(pool, pool[chosen[-1]]))
    return pool[chosen]


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(np.float64))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their distances to the pivots."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            found = to_pivots(matrix(batch.column("vector"), points.shape[1]).astype(np.int64), points)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(points)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), lists], names=["vec_id", "vector", "distances"])

    return rows.mapInArrow(measure, "vec_id long, vector array<int>, distances array<double>")


@dataclass
class Centroids:
    """Centroids, and their distances to the pivots."""

    points: np.ndarray
    distances: np.ndarray

    def nearest(self, vectors: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each vector (ties: the smaller number), its squared distance, and how many were measured."""
        bound = np.zeros((len(vectors), len(self.points)))
        for own, theirs in zip(distances.T, self.distances.T, strict=True):
            np.maximum(bound, np.abs(own[:, None] - theirs[None, :]), out=bound)
        bound -= SLACK * (distances.max(axis=1)[:, None] + self.distances.max(axis=1)[None, :])
        first = bound.argmin(axis=1)
        cluster, best = first.copy(), np.empty(len(vectors), np.int64)
        for k in np.unique(first).tolist():
            own = first == k
            best[own] = squared(vectors[own], self.points[k])
        reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
        measured = len(vectors)
        for k, point in enumerate(self.points):
            rows = np.flatnonzero((bound[:, k] <= reach) & (first != k))
            d = squared(vectors[rows], point)
            better = (d < best[rows]) | ((d == best[rows]) & (k < cluster[rows]))
            rows, d, measured = rows[better], d[better], measured + len(rows)
            best[rows], cluster[rows], reach[rows] = d, k, np.sqrt(d.astype(np.float64)) * (1 + SLACK)
        return cluster, best, measured


@dataclass
class Clustering:
    """``rows``: vec_id, cluster, distance; ``centroids``: the final ones; ``measured``: exact distances by round, of how many."""

    rows: DataFrame
    centroids: np.ndarray
    measured: list[tuple[int, int]] = field(default_factory=list)


def moved(table: DataFrame, centroids: Centroids) -> tuple[np.ndarray, tuple[int, int]]:
    """The centroids after one round, and how many distances were measured of how many."""
    shared = table.sparkSession.sparkContext.broadcast(centroids)
    k, width = centroids.points.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per centroid and task, whatever the number of vectors."""
        count, measured, sums = np.zeros(k, np.int64), 0, np.zeros((k, width), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("vector"), width).astype(np.int64)
            cluster, _, n = shared.value.nearest(vectors, matrix(batch.column("distances"), shared.value.distances.shape[1]))
            measured += n
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster).tolist():
                sums[c] += vectors[cluster == c].sum(axis=0)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), width).cast(pa.list_(pa.int64()))
        share = np.where(np.arange(k) == 0, measured, 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(count), lists, pa.array(share)], names=["cluster", "n", "sums", "measured"])

    whole = lambda c: F.sum(c.cast("decimal(20,0)"))
    partial = table.select("vector", "distances").mapInArrow(add_up, "cluster int, n long, sums array<long>, measured long")
    totals = partial.groupBy("cluster").agg(F.sum("n"), F.sum("measured"), *[whole(F.col("sums")[i]) for i in range(width)]).collect()
    points, rows, measured = centroids.points.copy(), 0, 0
    for cluster, n, m, *sums in totals:
        rows, measured = rows + n, measured + m
        if n:
            points[cluster] = [int(s) // n for s in sums]
    return points, (measured, rows * k)


def assigned(table: DataFrame, centroids: Centroids) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column("vector"), shared.value.points.shape[1]).astype(np.int64)
            cluster, distance, _ = shared.value.nearest(own, matrix(batch.column("distances"), shared.value.distances.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(assign, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> Clustering:
    """Clusters of whole-number vectors after a fixed number of rounds.

    vectors: vec_id, embedding; other columns are ignored, whatever their
    names. Rows without exactly ``dimensions`` components, or with a null or
    non-finite one, are left out. Components are floor(scale * x), held between
    -2**27 and 2**27: beyond that (x over two million) a squared distance would
    not fit in a long. Centroids start as the rows with the least hash of
    ``seed:vec_id``; rows alike in the hash go by vec_id (null last), then by
    components; fewer rows give fewer centroids. Ties in distance go to the
    smaller number; a centroid without vectors stays. Repeated rows count as
    often as they occur. No rows give no rows.

    The driver holds ``PIVOT_POOL`` vectors and the centroids. A round sends
    one row per centroid and task, however many vectors are alike.
    """
    kept = whole_vectors(vectors, dimensions, scale)
    order = [id_hash(seed), F.col("vec_id").isNull(), "vec_id", "vector"]
    pool = np.array([r["vector"] for r in kept.orderBy(*order).limit(max(PIVOT_POOL, centroids)).collect()], np.int64)
    if not len(pool):
        return Clustering(kept.limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance"), pool.reshape(0, dimensions))
    fixed = far_apart(pool, pivots)
    table = stored(pivot_table(kept, fixed), "pivot-table")
    points, measured = pool[:centroids].copy(), []
    for _ in range(rounds):
        points, share = moved(table, Centroids(points, to_pivots(points, fixed)))
        measured.append(share)
    rows = stored(assigned(table, Centroids(points, to_pivots(points, fixed))), "assigned")
    return Clustering(rows, points, measured)


def cluster_digest(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia (at most the largest long) and centroid_sha256."""
    found = cluster_vectors(vectors)
    total = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in found.rows.groupBy("cluster").agg(total.alias("total")).collect()}
    own = [min(sums.get(k, 0), LONGEST) for k in range(len(found.centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    pick = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")] if values else F.lit(None).cast(kind)
    return found.rows.select(
        "vec_id",
        "cluster",
        "distance",
        pick(own, "long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), LONGEST)).cast("long").alias("inertia"),
        pick(digests, "string").alias("centroid_sha256"),
    )
