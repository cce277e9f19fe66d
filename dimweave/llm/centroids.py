"""Centroid clustering with an incremental distance matrix.

Vectors become integers once.  Per vector the exact dot products with all
centroids are kept in a stored table; after a round, only the products of
centroid components that changed are added to them (``new = old + delta . x``
over the nonzero components of each centroid's ``delta``), and the nearest
centroid is found again from ``x.x - 2 x.c + c.c``.  All arithmetic is in
64-bit integers, so the table equals one computed anew.

A round is one pass over the table and one over its successor: the first
writes the new products and clusters, the second sums components per cluster
inside each task and then over the tasks (``k`` times ``dim`` numbers each, so a
cluster with a third of all rows is no heavier than another).  The driver
holds only the ``k`` centroids.  A table is dropped once its successor is
written; a lost executor reads the last one again.

Defined results: only vectors of exactly ``dim`` components, none null, NaN or
infinite, are kept; a component is ``floor(scale * x)`` with ``x`` as double; a
magnitude of ``LIMIT`` or more fails the run, since distances would leave 64
bits.  Centroids start as the kept vectors of the smallest hashes (ties: by
the integer components); fewer vectors give fewer centroids.  Equal distances
go to the smaller centroid, empty centroids stay.  Null ids hash as the empty
text and are kept; repeated rows count each; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import dropped, stored

DIM, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
#: Integer components below this keep every squared distance of 64 components under 2^63.
LIMIT = 1 << 27


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``_id, _x`` of the vectors that are kept, ``_x`` an array of ``dim`` integers."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    whole = (F.size(vector) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = rows.where(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).alias("_id"), F.transform(x, lambda v: F.floor(v * float(scale))).alias("_y"))
    small = F.forall("_y", lambda v: (v > -LIMIT) & (v < LIMIT))
    fails = F.raise_error(F.lit(f"a vector component is {LIMIT} or more in magnitude after scaling")).cast("array<int>")
    return kept.select("_id", F.when(small, F.col("_y").cast("array<int>")).otherwise(fails).alias("_x"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(order, "_x").limit(k).select("_x").collect()  # k vectors
    return np.array([r["_x"] for r in rows], np.int64) if rows else np.zeros((0, 0), np.int64)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), kind))


def updated_products(x: np.ndarray, products: np.ndarray, delta: np.ndarray) -> np.ndarray:
    """``products + x . delta``, touching only the nonzero components of each centroid's ``delta``."""
    out = products.copy()
    for k in range(len(delta)):
        changed = np.flatnonzero(delta[k])
        if len(changed):
            out[:, k] += x[:, changed] @ delta[k, changed]
    return out


def nearest(x: np.ndarray, products: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (ties: the smaller) and its squared distance."""
    far = (x * x).sum(axis=1)[:, None] - 2 * products + (centroids * centroids).sum(axis=1)[None, :]
    best = far.argmin(axis=1)
    return best, far[np.arange(len(x)), best]


def assigned(state: DataFrame, delta: np.ndarray, centroids: np.ndarray, first: bool) -> DataFrame:
    """The next state: products brought up to date by ``delta``, the cluster and distance under ``centroids``."""
    dim, k = centroids.shape[1], len(centroids)
    kind = dict(state.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("_x"), dim)
            products = updated_products(x, np.zeros((len(x), k), np.int64) if first else _matrix(b.column("_dots"), k), delta)
            cluster, distance = nearest(x, products, centroids)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_x"), _lists(products, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["_id", "_x", "_dots", "_cluster", "_distance"])

    return state.mapInArrow(run, f"_id {kind}, _x array<int>, _dots array<long>, _cluster int, _distance long")


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: componentwise floor of the mean of each cluster's vectors; empty ones stay."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)  # the last column counts vectors
        for b in batches:
            cluster = b.column("_cluster").to_numpy(zero_copy_only=False)
            np.add.at(total[:, :dim], cluster, _matrix(b.column("_x"), dim))
            total[:, dim] += np.bincount(cluster, minlength=k)
        at = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.reshape(-1)[at])], ["_at", "_sum"])

    parts = state.select("_cluster", "_x").mapInArrow(sums, "_at int, _sum long")
    total = np.zeros(k * (dim + 1), dtype=object)  # exact, however many vectors
    for r in parts.groupBy("_at").agg(F.sum(F.col("_sum").cast("decimal(38,0)")).alias("_sum")).collect():  # k * (dim + 1) rows at most
        total[r["_at"]] = int(r["_sum"])
    total = total.reshape(k, dim + 1)
    out = centroids.copy()
    for c in range(k):
        if total[c, dim]:
            out[c] = [int(s) // int(total[c, dim]) for s in total[c, :dim]]
    return out


def cluster_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE,
                    k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """``(_id, _x, _dots, _cluster, _distance)`` after ``rounds`` updates and a last assignment, and the final centroids."""
    vectors = stored(integer_vectors(rows, vec_id, vector, dim, scale), "centroid-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        empty = vectors.selectExpr("_id", "_x", "array(0L) _dots", "0 _cluster", "0L _distance")
        return empty.where("false"), centroids
    state, delta = vectors, centroids
    for turn in range(rounds + 1):
        after = stored(assigned(state, delta, centroids, turn == 0), "centroid-products")
        dropped(state)
        state = after
        if turn < rounds:
            new = moved(state, centroids)
            delta, centroids = new - centroids, new
    return state, centroids


def centroid_digests(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """``cluster, centroid_sha256`` of every centroid."""
    rows = [(c, hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest()) for c, x in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, centroid_sha256 string")


def with_inertia(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector."""
    per = state.groupBy("_cluster").agg(F.sum("_distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia"))
    digests = centroid_digests(state.sparkSession, centroids)
    facts = per.crossJoin(F.broadcast(total)).join(digests, F.col("_cluster") == F.col("cluster")).drop("_cluster")  # one row per centroid
    rows = state.select("_id", F.col("_cluster").alias("cluster"), F.col("_distance").alias("distance"))
    return rows.join(F.broadcast(facts), "cluster")


__all__ = ["integer_vectors", "first_centroids", "updated_products", "nearest", "assigned", "moved", "cluster_vectors", "centroid_digests", "with_inertia"]
