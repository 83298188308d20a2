"""Clustering around centroids with Ptolemaic pivots.

By Ptolemy's inequality the distance of a vector x to a centroid c is at least |d(x,p) d(c,s) - d(x,s) d(c,p)| / d(p,s)
for any two pivots p and s. The distances of all vectors to a few fixed pivots are kept beside the vectors; each round
only needs those of the centroids. A centroid whose bound, rounded down, exceeds the best exact distance so far is
passed over, and the distance to any other is computed in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import column_of
from shardloom.llm.topk import matrix, whole_vector
from shardloom.session import as_written

SCALE, DIM, CENTROIDS, ROUNDS, SEED = 256, 64, 40, 5, 2
#: Pivots, and which of them make a pair.
PIVOTS = 8
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7), (0, 4), (1, 5), (2, 6), (3, 7)]
#: Components of whole numbers up to this size keep squared distances within a long.
MOST = 1 << 27
#: Share of the products by which bounds are lowered, far above what rounding can add.
SLACK = 1e-9


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one vector."""
    apart = v - c
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(centroids: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Some of the first centroids that lie far apart: each the farthest from those before it."""
    picked = [0]
    near = squared(centroids, centroids[0])
    while len(picked) < min(n, len(centroids)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, squared(centroids, centroids[picked[-1]]))
    return centroids[picked]


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.array([squared(v, p) for p in pivots], np.float64).reshape(len(pivots), len(v)).T)


def lower_bounds(dx: np.ndarray, dc: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to centroids that the pivot pairs prove, rounded down: one column per centroid."""
    out = np.zeros((len(dx), len(dc)))
    for p, s in PAIRS:
        if max(p, s) < len(between) and between[p, s] > 0:
            a, b = dx[:, p, None] * dc[None, :, s], dx[:, s, None] * dc[None, :, p]
            np.maximum(out, (np.abs(a - b) - SLACK * (a + b)) / between[p, s], out=out)
    return out ** 2 * (1 - SLACK)


def nearest(v: np.ndarray, dx: np.ndarray, centroids: np.ndarray, dc: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, ties to the smaller, and its squared distance. That of the least bound is tried first."""
    bound = lower_bounds(dx, dc, between)
    at = bound.argmin(axis=1)
    apart = v - centroids[at]
    best = np.einsum("ij,ij->i", apart, apart)
    for c in range(len(centroids)):
        left = np.flatnonzero((bound[:, c] <= best) & (at != c))
        d = squared(v[left], centroids[c])
        won = (d < best[left]) | ((d == best[left]) & (c < at[left]))
        at[left[won]], best[left[won]] = c, d[won]
    return at, best


def _assigner(centroids: np.ndarray, pivots: np.ndarray):
    dc, between = pivot_distances(centroids, pivots), pivot_distances(pivots, pivots)

    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = matrix(column_of(batch, "v"), centroids.shape[1])
        dx = column_of(batch, "far").flatten().to_numpy(zero_copy_only=False).reshape(len(v), len(pivots))
        return v, *nearest(v, dx, centroids, dc, between)

    return assign


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """Per task one row of sums for each centroid that got vectors."""
    assign, (k, dim) = _assigner(centroids, pivots), centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            if batch.num_rows:
                v, at, _ = assign(batch)
                by = np.argsort(at, kind="stable")
                own, first = np.unique(at[by], return_index=True)
                total[own] += np.add.reduceat(v[by], first, axis=0)
                n += np.bincount(at, minlength=k)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    return work


def moved(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means; a centroid without vectors stays."""
    sums = points.select("v", "far").mapInArrow(_sums(centroids, pivots), "cluster int, n long, total array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    found = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[wide(F.col("total")[i]) for i in range(centroids.shape[1])]).alias("total"))
    out = centroids.copy()
    for r in found.collect():  # one row per centroid at most
        out[r["cluster"]] = [int(t) // r["n"] for t in r["total"]]
    return out


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    assign = _assigner(centroids, pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, at, best = assign(batch)
                yield pa.RecordBatch.from_arrays([column_of(batch, "vec_id"), pa.array(at.astype(np.int32)), pa.array(best)],
                                                 names=["vec_id", "cluster", "distance"])

    return work


def _with_pivots(pivots: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(column_of(batch, "v"), pivots.shape[1])
                if np.abs(v).max() > MOST:
                    raise ValueError(f"components beyond {MOST} in size: squared distances do not fit a long")
                far = pa.array(pivot_distances(v, pivots).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([column_of(batch, "vec_id"), column_of(batch, "v"), far], names=["vec_id", "v", "far"])

    return work


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clusters(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: int = SEED,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part.

    Vectors of another length than ``dim``, null ones and those that hold a null or non-finite component are left out.
    The first centroids are the ``k`` vectors of the smallest hash of the id (a null id counts as empty text, equal
    hashes by the vectors), all of them if there are fewer; equal centroids stay apart and ties go to the smaller
    number. Repeated rows count as often as they occur. An empty table gives an empty result; extra columns are not
    read. Components must stay below 2**27 after scaling, else the job raises. A round is one pass over the written
    vectors from which one row of sums per centroid and task comes back; the centroids are on the driver.
    """
    spark: SparkSession = rows.sparkSession
    v = F.col(vector_col)
    kept = as_written(rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.size(v) == dim, whole_vector(v, scale)).alias("v"))
                      .filter("v is not null"), "whole")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(named.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    if not first:
        none = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], none)
    centroids = np.array([r["v"] for r in first], np.int64)
    pivots = choose_pivots(centroids)
    points = as_written(kept.mapInArrow(_with_pivots(pivots), "vec_id long, v array<long>, far array<double>"), "points")
    for _ in range(rounds):
        centroids = moved(points, centroids, pivots)
    found = as_written(points.mapInArrow(_assigned(centroids, pivots), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    few = spark.createDataFrame([(c, s, sum(sums.values()), digest(centroids[c])) for c, s in sums.items()],
                                "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(few), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
