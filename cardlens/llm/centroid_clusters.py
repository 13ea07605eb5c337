"""Centroid clustering with exact integers, pruned by Ptolemy's inequality.

For pivots p and s, a vector v and a centroid c

    d(v, c) * d(p, s) >= |d(v, p) * d(c, s) - d(v, s) * d(c, p)|

holds in Euclidean space. The distances of every vector to the pivots do not change between
rounds: they are computed once and stored beside the vector. Those of the centroids are a
few numbers a round. A vector then looks at a centroid itself only if the largest bound over
the fixed pivot pairs, made a little smaller against rounding, does not pass the best distance
found so far. Distances that are looked at are sums of integers, so ties are ties.

Centroids (some dozen vectors) are on the driver between rounds; vectors never are. A task
adds its vectors up by cluster, and Spark adds up the tasks' sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.vectors import matrix
from cardlens.sources.scratch import store

PIVOTS = 6  # 15 pairs
BLOCK_ROWS = 4_096  # vectors that are compared with all centroids at once
# integers up to here have squared distances that fit 64 bits in any dimension up to 64
LARGEST = 1 << 27
ROUNDING = 1e-9  # relative to the products, far above what double precision loses


@dataclass(frozen=True)
class Pivots:
    points: np.ndarray  # (pivots, dimensions), integers
    first: np.ndarray  # of each pair
    second: np.ndarray
    apart: np.ndarray  # distance within each pair


def squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to one integer point, exact."""
    difference = x - point
    return np.einsum("ij,ij->i", difference, difference)


def to_points(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances (rows, points) in double precision."""
    return np.sqrt(np.stack([squared(x, p) for p in points], axis=1).astype(np.float64))


def choose_pivots(candidates: np.ndarray, n: int = PIVOTS) -> Pivots:
    """Points far from each other: each is the candidate farthest from those chosen before."""
    chosen, nearest = [0], squared(candidates, candidates[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(candidates, candidates[chosen[-1]]))
    points = candidates[chosen]
    pairs = np.array(list(combinations(range(len(chosen)), 2)), np.int64).reshape(-1, 2)
    between = to_points(points, points)
    return Pivots(points, pairs[:, 0], pairs[:, 1], between[pairs[:, 0], pairs[:, 1]])


def lower_bounds(cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Bounds (rows, centroids) that no true distance is below, from distances to pivots."""
    bounds = np.zeros((len(cached), len(centroids)))
    for p, s, apart in zip(pivots.first, pivots.second, pivots.apart):
        left = np.outer(cached[:, p], centroids[:, s])
        right = np.outer(cached[:, s], centroids[:, p])
        bound = np.abs(left - right) - ROUNDING * (left + right)
        np.maximum(bounds, bound / apart, out=bounds)
    return bounds


def nearest(x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each row, and how many distances were computed.

    Each row begins with the centroid of its smallest bound; among equally near ones the
    smaller number wins.
    """
    bounds = lower_bounds(cached, to_points(centroids, pivots.points), pivots)
    cluster = bounds.argmin(axis=1)
    begun = cluster.copy()
    difference = x - centroids[begun]
    best = np.einsum("ij,ij->i", difference, difference)
    visits = len(x)
    for c in range(len(centroids)):
        # a little above the root, so that rounding of the root cannot rule out a tie
        reach = np.sqrt(best.astype(np.float64)) * (1 + ROUNDING)
        rows = np.flatnonzero((bounds[:, c] <= reach) & (begun != c))
        found = squared(x[rows], centroids[c])
        visits += len(rows)
        closer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        best[rows[closer]], cluster[rows[closer]] = found[closer], c
    return cluster.astype(np.int32), best, visits


def _cached(batches: Iterator[pa.RecordBatch], pivots: Pivots) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("q")).astype(np.int64)
        near = to_points(x, pivots.points) if len(x) else np.zeros((0, len(pivots.points)))
        yield batch.append_column("to_pivots", pa.array(list(near), pa.list_(pa.float64())))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, matrix(part.column("q")).astype(np.int64), matrix(part.column("to_pivots"))


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: Pivots) -> Iterator[pa.RecordBatch]:
    """Count and componentwise sum of a block's vectors, by cluster."""
    for _, x, cached in _blocks(batches):
        cluster, _, _ = nearest(x, cached, centroids, pivots)
        order = np.argsort(cluster, kind="stable")
        present, starts, counts = np.unique(cluster[order], return_index=True, return_counts=True)
        sums = np.add.reduceat(x[order], starts, axis=0)
        yield pa.record_batch(
            [pa.array(present, pa.int32()), pa.array(counts, pa.int64()), pa.array(list(sums), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: Pivots) -> Iterator[pa.RecordBatch]:
    for batch, x, cached in _blocks(batches):
        cluster, distance, _ = nearest(x, cached, centroids, pivots)
        yield pa.record_batch(
            [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
            names=["vec_id", "cluster", "distance"],
        )


def integer_vectors(rows: DataFrame, dimensions: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, q) of the usable vectors: q holds floor(scale * x) of every component x.

    Usable are vectors of exactly ``dimensions`` components, none null, NaN or infinite.
    Integers beyond 2**27 are refused with them: their squared distances fit no long.
    """
    v = F.col("embedding").cast("array<double>")
    largest = F.lit(float(LARGEST))
    fine = (F.size(v) == dimensions) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < largest)
    )
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("bigint"))
    return rows.filter(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("q")
    )


def seed_hash(vec_id: Column, seed: int = 1) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """Centroids after a round: floor of sum / count, from (cluster, dimension, n, total)."""
    out = centroids.copy()
    for row in sums:
        out[row["cluster"], row["dimension"]] = int(row["total"]) // int(row["n"])
    return out


def cluster_vectors(
    rows: DataFrame, clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each usable vector.

    ``rows`` has ``vec_id`` and ``embedding``; other columns are ignored. Vectors become
    integers (``integer_vectors``). The first centroids are the vectors whose ids have the
    smallest seeded hashes, in that order; there are fewer if vectors are. Each round assigns all vectors,
    then moves every centroid with members to the floor of their mean. Null ids hash like an
    empty one; rows that share an id are vectors of their own, the smaller components
    first where they start. Copies all count. An empty table gives an empty result. A sum of
    distances beyond 64 bits is null.
    """
    spark = rows.sparkSession
    whole = integer_vectors(rows, dimensions, scale)
    digest = seed_hash(F.col("vec_id"), seed)
    start = [r.q for r in whole.orderBy(digest, "q").select("q").limit(clusters).collect()]
    schema = (
        "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    if not start:
        return spark.createDataFrame([], schema)
    centroids = np.array(start, np.int64)
    pivots = choose_pivots(centroids)
    cached = store(
        whole.mapInArrow(partial(_cached, pivots=pivots), "vec_id bigint, q array<bigint>, to_pivots array<double>"),
        "integer-vectors",
    )
    for _ in range(rounds):
        task = partial(_sums, centroids=centroids, pivots=pivots)
        part = cached.select("q", "to_pivots").mapInArrow(task, "cluster int, n bigint, sums array<bigint>")
        # one row a cluster and dimension reaches the driver
        totals = (
            part.select("cluster", "n", F.posexplode("sums").alias("dimension", "s"))
            .groupBy("cluster", "dimension")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("total"))
        )
        centroids = moved(centroids, totals.collect())
    task = partial(_assigned, centroids=centroids, pivots=pivots)
    assigned = store(cached.mapInArrow(task, "vec_id bigint, cluster int, distance bigint"), "assigned-vectors")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = {r["cluster"]: int(r["own"]) for r in assigned.groupBy("cluster").agg(wide.alias("own")).collect()}
    inertia = _long(sum(own.values()))
    facts = [
        (c, _long(own[c]), inertia, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c in sorted(own)
    ]
    named = spark.createDataFrame(
        facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # one row a cluster
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(total: int) -> int | None:
    return total if total < 1 << 63 else None
