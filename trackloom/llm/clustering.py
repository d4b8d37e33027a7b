"""Centroid clustering with Drake's adaptive bounds, exact in integers.

Each vector keeps an upper bound of the distance to its centroid, the numbers and lower bounds of the next few nearest centroids, and one lower
bound for all the rest. A round moves the bounds by how far the centroids moved. A vector whose upper bound lies under all lower bounds keeps its
centroid without a look at any other. Otherwise its own distance is taken exactly; then, if the rest's bound still holds, only the few near centroids
are scanned, and all of them if it doesn't. Bounds are rounded outwards, so they never decide a tie: equal distances are always scanned.

A round is one pass over the table of vectors and bounds, without a shuffle, written to the shared folder. Sums are carried from round to
round: only vectors that changed their centroid are added and taken away. What meets in the driver is k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import drop_table, map_rows, materialize

SCALE, LARGEST, DIMS = 1024, 1 << 27, 64
CENTROIDS, ROUNDS, NEAR = 8, 10, 3
#: Bounds differ at least by this share before they certify anything; rounding errors are far smaller.
MARGIN = 1e-9
STATE = "vec_id long, vector binary, cluster int, was int, upper double, near binary, lower binary"
BATCH = 8192


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id, vector: floor(1024 * x) of each component of the vectors that are kept."""
    x = F.col("embedding")
    fits = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double") * SCALE) < LARGEST, F.lit(False)))  # false for infinities; NaN is larger than all
    whole = F.coalesce((F.size(x) == dims) & fits, F.lit(False))
    return vectors.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int")).alias("vector"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors of the smallest hashes, in that order; vectors without an id only if there are no others."""
    hashed = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(hashed.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([r["vector"] for r in rows], np.int64)


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances; centroid is one for all rows, or one for each."""
    step = rows - centroid
    return (step * step).sum(axis=1)


class Bounds:
    """Clusters and bounds of a batch of vectors: near and lower have a row for each vector, lower with the remainder bound at its end."""

    def __init__(self, vectors: np.ndarray, k: int, near: int) -> None:
        self.vectors, self.k, self.n_near = vectors, k, max(0, min(near, k - 1))
        n = len(vectors)
        self.cluster, self.upper = np.zeros(n, np.int64), np.full(n, np.inf)
        self.near, self.lower = np.zeros((n, self.n_near), np.int64), np.full((n, self.n_near + 1), -np.inf)

    def moved(self, by: np.ndarray) -> None:
        """The centroids have moved by so much each, rounded up."""
        self.upper += by[self.cluster]
        self.lower[:, :-1] -= by[self.near]
        self.lower[:, -1] -= by.max(initial=0)

    def assign(self, centroids: np.ndarray) -> int:
        """Give every vector its nearest centroid, of equals the smaller number. How many vectors were held against all centroids."""
        open_ = np.flatnonzero(~(self.upper * (1 + MARGIN) < self.lower.min(axis=1)))
        own = squared(self.vectors[open_], centroids[self.cluster[open_]])
        self.upper[open_] = np.sqrt(own) * (1 + MARGIN)
        open_ = open_[~(self.upper[open_] * (1 + MARGIN) < self.lower[open_].min(axis=1))]
        few = self.upper[open_] * (1 + MARGIN) < self.lower[open_, -1]
        self._scan(open_[few], np.column_stack([self.cluster[open_[few]], self.near[open_[few]]]), centroids, rest=False)
        whole = open_[~few]
        self._scan(whole, np.broadcast_to(np.arange(self.k), (len(whole), self.k)), centroids, rest=True)
        return len(whole)

    def _scan(self, rows: np.ndarray, numbers: np.ndarray, centroids: np.ndarray, rest: bool) -> None:
        """Order the rows' centroids `numbers` by exact distance. rest: they are all there are, so the remainder bound is new as well."""
        if not len(rows):
            return
        far = np.stack([squared(self.vectors[rows], centroids[numbers[:, j]]) for j in range(numbers.shape[1])], axis=1)
        order = np.lexsort((numbers, far), axis=1)
        numbers, far = np.take_along_axis(numbers, order, 1), np.sqrt(np.take_along_axis(far, order, 1))
        self.cluster[rows], self.upper[rows] = numbers[:, 0], far[:, 0] * (1 + MARGIN)
        self.near[rows], self.lower[rows, :-1] = numbers[:, 1 : self.n_near + 1], far[:, 1 : self.n_near + 1] * (1 - MARGIN)
        if rest:
            self.lower[rows, -1] = far[:, self.n_near + 1] * (1 - MARGIN) if self.k > self.n_near + 1 else np.inf


def _raw(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _read(column: pa.Array, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)


def _state(ids: pa.Array, raw: pa.Array, b: Bounds, was: np.ndarray) -> pa.RecordBatch:
    columns = [ids, raw, pa.array(b.cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(b.upper), _raw(b.near.astype("<u4")), _raw(b.lower.astype("<f8"))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in STATE.split(", ")])


def first_pass(kept: DataFrame, centroids: np.ndarray, near: int = NEAR) -> DataFrame:
    """The state of every vector after the first assignment; nothing was before it (-1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            vectors = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            bounds = Bounds(vectors.astype(np.int64), len(centroids), near)
            bounds.assign(centroids)
            yield _state(part.column(0), _raw(vectors.astype("<i4")), bounds, np.full(part.num_rows, -1))

    return map_rows(kept, run, STATE, BATCH)


def next_pass(state: DataFrame, before: np.ndarray, centroids: np.ndarray, near: int = NEAR) -> DataFrame:
    """The state after another assignment, to centroids that stood at `before` until now."""
    by = np.sqrt(squared(centroids, before)) * (1 + MARGIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            n = part.num_rows
            bounds = Bounds(_read(part.column(1), "<i4", n).astype(np.int64), len(centroids), near)
            was = part.column(2).to_numpy()
            bounds.cluster, bounds.upper = was.astype(np.int64), part.column(4).to_numpy().copy()
            bounds.near, bounds.lower = _read(part.column(5), "<u4", n).astype(np.int64).reshape(n, bounds.n_near), _read(part.column(6), "<f8", n).copy()
            bounds.moved(by)
            bounds.assign(centroids)
            yield _state(part.column(0), part.column(1), bounds, was)

    return map_rows(state, run, STATE, BATCH)


def changes(state: DataFrame, k: int, dims: int) -> np.ndarray:
    """What the last pass changed in each centroid's sums and, in the last column, its count: k rows of dims + 1, whatever the table's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for part in batches:
            vectors, now, was = _read(part.column(0), "<i4", part.num_rows), part.column(1).to_numpy(), part.column(2).to_numpy()
            for c in range(k):
                for rows, sign in ((now == c, 1), (was == c, -1)):
                    total[c, :-1] += sign * vectors[rows].sum(axis=0, dtype=np.int64)
                    total[c, -1] += sign * int(rows.sum())
        c, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(j, pa.int32()), pa.array(total[c, j], pa.int64())], names=["c", "j", "s"])

    moved = state.filter("cluster <> was").select("vector", "cluster", "was")
    out = np.zeros((k, dims + 1), np.int64)
    for r in map_rows(moved, run, "c int, j int, s long", BATCH).groupBy("c", "j").agg(F.sum("s").alias("s")).collect():
        out[r["c"], r["j"]] = r["s"]
    return out


def distances(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance: squared, to the vector's own centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            far = squared(_read(part.column(1), "<i4", part.num_rows).astype(np.int64), centroids[part.column(2).to_numpy()])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(far)], names=["vec_id", "cluster", "distance"])

    return map_rows(state.select("vec_id", "vector", "cluster"), run, "vec_id long, cluster int, distance long", BATCH)


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, near: int = NEAR, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector of vectors(vec_id, embedding, ...).

    Kept are vectors of exactly dims components, none null or non-finite, and none of 2^27 or more once scaled, whose squares fit no long. Null and
    empty vectors aren't kept. Repeated rows count as often as they occur; rows without a vec_id are clustered, but begin a centroid only where others
    lack. With fewer than k kept vectors there are as many centroids. Equal distances go to the smaller number. Other columns are not
    read; without a kept vector the result is empty.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims)
    centroids = first_centroids(kept, k)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state = materialize(first_pass(kept, centroids, near), "clusters")
    sums = np.zeros((len(centroids), dims + 1), np.int64)
    for _ in range(rounds):
        sums += changes(state, len(centroids), dims)
        n = sums[:, -1:]
        moved = np.where(n > 0, sums[:, :-1] // np.maximum(n, 1), centroids)  # // rounds down
        if (moved == centroids).all():
            break  # no later round can change anything
        state, old = materialize(next_pass(state, centroids, moved, near), "clusters"), state
        drop_table(old)
        centroids = moved
    found = materialize(distances(state, centroids), "distances")
    drop_table(state)
    own = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    told = [(c, s, sum(own.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in own.items()]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
