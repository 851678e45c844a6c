"""Centroid clustering with heap-ordered bounds.

For each vector the gap between its second nearest and its nearest centroid bounds how far the
centroids may drift before it can belong to another cluster. A block of vectors keeps one heap per
cluster, keyed by the gap at the last scan plus the drift that its cluster had gathered by then.
In a round only vectors whose key lies within the drift gathered since leave the heap and are
scanned again, by exact integer distances; all others keep their cluster unseen.

A round reads the blocks, changes their heaps and writes them again: no vector is shuffled. What
the moved vectors change in the sums of the clusters is added up from a column of the blocks, as
many numbers as there are clusters and dimensions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.negatives import integer_vectors
from strata.llm.shared import discard, stored

#: Vectors of a block; a row of the stored tables is a block.
BLOCK = 1024
SCALE = 1024.0
#: Share of a bound that floating point may be off by, far above what it is.
MARGIN = 1e-9

STATE = (
    "vec_id array<bigint>, v array<int>, cluster array<int>, heap_size array<int>, "
    "heap_key array<double>, heap_at array<int>, scanned bigint, moved array<bigint>"
)


class Heaps:
    """One heap per cluster of (key, position of the vector in its block)."""

    def __init__(self, k: int, sizes=(), keys=(), at=()):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        start = 0
        for heap, n in zip(self.heaps, sizes):
            # Stored in heap order.
            heap += zip(keys[start : start + n], at[start : start + n])
            start += n

    def push(self, cluster: int, key: float, at: int) -> None:
        heapq.heappush(self.heaps[cluster], (key, at))

    def expired(self, drift: np.ndarray) -> list[int]:
        """Takes out the vectors whose key the drift of their cluster has reached."""
        out = []
        for heap, gone in zip(self.heaps, drift.tolist()):
            while heap and heap[0][0] <= gone:
                out.append(heapq.heappop(heap)[1])
        return out

    def columns(self) -> tuple[list[int], list[float], list[int]]:
        flat = [x for heap in self.heaps for x in heap]
        return [len(h) for h in self.heaps], [key for key, _ in flat], [at for _, at in flat]


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, in 64-bit integers: one row for each vector, one column for each centroid."""
    cross = vectors @ centroids.T
    return (vectors * vectors).sum(axis=1)[:, None] - 2 * cross + (centroids * centroids).sum(axis=1)


def gaps(distances: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(second nearest minus nearest distance, their sum); endless with a single centroid."""
    rows = np.arange(len(own))
    near = np.sqrt(distances[rows, own].astype(np.float64))
    others = distances.astype(np.float64)
    others[rows, own] = np.inf
    far = np.sqrt(others.min(axis=1))
    return far - near, far + near


def _rows(v: np.ndarray, dims: int) -> np.ndarray:
    return v.reshape(-1, dims).astype(np.int64)


def _blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vec_id, v) -> blocks whose vectors belong to no cluster yet."""
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                values = part.column(1).flatten()
                yield _state(
                    part.column(0), values, pa.array(np.full(part.num_rows, -1, np.int32)), ([], [], []), 0, []
                )

    return run


def _state(ids: pa.Array, v: pa.Array, cluster: pa.Array, heaps, scanned: int, moved) -> pa.RecordBatch:
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    sizes, keys, at = heaps
    return pa.RecordBatch.from_arrays(
        [
            whole(ids), whole(v), whole(cluster), one(sizes, pa.int32()), one(keys, pa.float64()), one(at, pa.int32()),
            pa.array([scanned], pa.int64()), one(moved, pa.int64()),
        ],
        names=["vec_id", "v", "cluster", "heap_size", "heap_key", "heap_at", "scanned", "moved"],
    )


def _round(centroids: np.ndarray, drift: np.ndarray):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, v, cluster, sizes, keys, at = (batch.column(c)[i].values for c in range(6))
                own = cluster.to_numpy().copy()
                heaps = Heaps(k, sizes.to_pylist(), keys.to_pylist(), at.to_pylist())
                scan = np.array([*np.flatnonzero(own < 0).tolist(), *heaps.expired(drift)], dtype=np.int64)
                moved = np.zeros((k, dims + 1), dtype=np.int64)
                if len(scan):
                    vectors = _rows(v.to_numpy(), dims)[scan]
                    distances = squared_distances(vectors, centroids)
                    new = distances.argmin(axis=1).astype(np.int32)
                    gap, size = gaps(distances, new)
                    key = gap + drift[new] - MARGIN * (np.where(np.isfinite(size), size, 0) + drift[new])
                    for c, g, where in zip(new.tolist(), key.tolist(), scan.tolist()):
                        heaps.push(c, g, where)
                    old = own[scan]
                    changed = old != new
                    counted = np.column_stack((np.ones(len(scan), np.int64), vectors))[changed]
                    np.add.at(moved, new[changed], counted)
                    was = old[changed] >= 0
                    np.subtract.at(moved, old[changed][was], counted[was])
                    own[scan] = new
                yield _state(ids, v, pa.array(own), heaps.columns(), len(scan), moved.ravel().tolist())

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks -> (vec_id, cluster, distance)."""
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(2)[i].values
                vectors = _rows(batch.column(1)[i].values.to_numpy(), centroids.shape[1])
                apart = vectors - centroids[own.to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, own, pa.array((apart * apart).sum(axis=1))],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def first_centroids(table: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors (all, if fewer) with the smallest sha256 of ``seed`` and their id."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    return np.array([r.v for r in table.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()], dtype=np.int64)


def _changes(blocks: DataFrame) -> np.ndarray:
    """The sums of the blocks' changes: one number for each cluster and dimension."""
    sums = blocks.select(F.posexplode("moved").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(sums), dtype=np.int64)
    for r in sums:
        out[r["at"]] = r["n"]
    return out


def cluster_vectors(
    embeddings: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    seed: str = "3:",
    vector: str = "embedding",
    key: str = "vec_id",
    scale: float = SCALE,
    report: list | None = None,
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its
    components, an array of longs).

    Vectors of exactly ``dims`` components, none null or not finite, count, as integers
    floor(scale * x). Centroids 0, 1, ... start as the ``k`` vectors whose sha256 of ``seed`` and
    id is smallest. Each round assigns every vector to its nearest centroid by squared Euclidean
    distance (ties: the smaller number) and moves each centroid that has vectors to the floor of
    their mean; then they are assigned once more. Results are those of scanning every vector in
    every round. ``report`` gets the number of vectors scanned in each assignment.

    With fewer than ``k`` vectors there are as many centroids; equal vectors among the first make
    equal centroids, of which the larger numbers stay empty and where they are. A null key is kept
    and comes last among the first; repeated rows and keys are vectors of their own; an empty table
    gives no rows.
    """
    fitting = embeddings.filter(F.size(vector) == dims)
    vectors = stored(integer_vectors(fitting, scale, vector, key).drop("row"))
    centroids = first_centroids(vectors, k, seed)
    k = len(centroids)
    blocks = stored(vectors.mapInArrow(_blocks(dims), STATE))
    if not k:
        centroids = np.zeros((0, dims), dtype=np.int64)
    discard(vectors)
    drift, totals = np.zeros(k), np.zeros((k, dims + 1), dtype=np.int64)
    for number in range(rounds + 1 if k else 0):
        before, blocks = blocks, stored(blocks.mapInArrow(_round(centroids, drift), STATE))
        discard(before)
        if report is not None:
            report.append(blocks.agg(F.sum("scanned")).first()[0])
        if number == rounds:
            break
        totals += _changes(blocks).reshape(totals.shape)
        count = totals[:, :1]
        moved = np.where(count > 0, totals[:, 1:] // np.maximum(count, 1), centroids)
        length = np.sqrt(squared_moves(centroids, moved).astype(np.float64))
        # A vector's nearest centroid and the one that moved most of the others may close in on it.
        others = np.array([max(np.delete(length, c), default=0.0) for c in range(k)])
        drift = drift + (length + others) * (1 + MARGIN)
        centroids = moved
    found = stored(blocks.mapInArrow(_assigned(centroids), "vec_id bigint, cluster int, distance bigint"))
    discard(blocks)
    return _with_inertia(found, centroids)


def squared_moves(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return ((one - other) ** 2).sum(axis=1)


def _with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors with the sums of their cluster and of all, and their centroid: a table of as
    many rows as clusters is sent to them."""
    spark = found.sparkSession
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    clusters = [(c, i, sum(inertia.values()), centroids[c].tolist()) for c, i in sorted(inertia.items())]
    table = spark.createDataFrame(clusters, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(table), "cluster")
