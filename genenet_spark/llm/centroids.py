"""Centroid clustering in whole numbers (operator 12), pruned by Ptolemaic pivots.

For points x, c and pivots p, q, Ptolemy's inequality gives
``d(x, c) * d(p, q) >= |d(x, p) * d(c, q) - d(x, q) * d(c, p)|``. Every vector keeps its
distances to a few fixed pivots; each round bounds its distance to every centroid from
them, and only the centroids that the bounds leave are measured, in exact arithmetic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, freeze, map_batches
from genenet_spark.llm.vectors import BLOCK_ROWS, LIMB_SCHEMA, all_finite, limb_batch, matrix, sum_limbs, whole, wide

FACTOR = 64
DIM = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 6
#: Relative room for the rounding of bounds: some thousand times what doubles need here.
ROOM = 1e-12

BLOCK_SCHEMA = "ids array<bigint>, x binary, far binary"


def _squares(x: np.ndarray, point: list[int]) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``point``."""
    if x.dtype != object and max(map(abs, point), default=0) >= 1 << 26:
        x = x.astype(object)
    diff = x - np.array(point, dtype=x.dtype)
    return (diff * diff).sum(axis=1)


def _lengths(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def choose_pivots(points: list[list[int]], most: int = PIVOTS) -> list[list[int]]:
    """Up to ``most`` different points: the first, then always the one that is farthest from those chosen."""
    if not points:
        return []
    chosen = [points[0]]
    all_points = np.array(points, dtype=object)
    near = _squares(all_points, points[0])
    while len(chosen) < most and max(near) > 0:
        chosen.append(points[int(np.argmax(near))])
        near = np.minimum(near, _squares(all_points, chosen[-1]))
    return chosen


def _pack(pivots: list[list[int]], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = matrix(part.column(1), dim)
                far = np.stack([_lengths(_squares(wide(x), p)) for p in pivots])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                    pa.array([far.tobytes()], pa.binary())], names=["ids", "x", "far"])

    return run


class Assigner:
    """The nearest of ``centroids`` for rows with known distances to ``pivots``."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]]):
        self.centroids = centroids
        points = np.array(centroids, dtype=object)
        self.far = np.stack([_lengths(_squares(points, p)) for p in pivots])  # pivot, centroid
        self.pairs = []
        for i, p in enumerate(pivots):
            between = _lengths(_squares(np.array(pivots, dtype=object), p))
            self.pairs += [(i, j, between[j]) for j in range(i + 1, len(pivots))]
        self.measured = 0

    def bounds(self, far: np.ndarray) -> np.ndarray:
        """Row by centroid: never above the true distance."""
        low = np.zeros((far.shape[1], len(self.centroids)))
        for i, j, between in self.pairs:
            one, two = np.outer(far[i], self.far[j]), np.outer(far[j], self.far[i])
            np.maximum(low, (np.abs(one - two) - ROOM * (one + two)) / between, out=low)
        # With one of the pair on the vector itself the inequality is the triangle's; it also serves a single pivot.
        for i in range(len(far)):
            one, two = far[i][:, None], self.far[i][None, :]
            np.maximum(low, np.abs(one - two) - ROOM * (one + two), out=low)
        return low * (1 - ROOM)

    def nearest(self, x: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``cluster, squared distance`` of every row; ties to the smaller number."""
        x = wide(x)
        low = self.bounds(far)
        cluster = low.argmin(axis=1)
        best = np.zeros(len(x), dtype=x.dtype if x.dtype == object else np.int64)
        for c in np.unique(cluster):
            at = np.flatnonzero(cluster == c)
            best[at] = _squares(x[at], self.centroids[c])
        self.measured += len(x)
        first = cluster.copy()
        for c, point in enumerate(self.centroids):
            at = np.flatnonzero((low[:, c] <= _lengths(best) * (1 + ROOM)) & (first != c))
            self.measured += len(at)
            d = _squares(x[at], point)
            nearer = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
            best[at[nearer]], cluster[at[nearer]] = d[nearer], c
        return cluster, best


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    for batch in batches:
        for ids, x, far in zip(batch.column(0), batch.column(1), batch.column(2)):
            rows = np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dim)
            yield ids.as_py(), rows, np.frombuffer(far.as_buffer(), np.float64).reshape(-1, len(rows))


def _summer(centroids: list[list[int]], pivots: list[list[int]], dim: int):
    """Exact sums by cluster and dimension of a task's vectors; dimension ``dim`` has the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(centroids, pivots)
        sums = [[0] * (dim + 1) for _ in centroids]
        for _, x, far in _blocks(batches, dim):
            cluster, _ = assigner.nearest(x, far)
            for c in np.unique(cluster):
                mine = wide(x)[cluster == c]
                sums[c] = [a + int(b) for a, b in zip(sums[c], [*mine.sum(axis=0), len(mine)])]
        cluster = pa.array([c for c in range(len(centroids)) for _ in range(dim + 1)], pa.int32())
        at = pa.array([*range(dim + 1)] * len(centroids), pa.int32())
        yield limb_batch({"cluster": cluster, "at": at}, [v for row in sums for v in row])

    return run


def _labeller(centroids: list[list[int]], pivots: list[list[int]], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(centroids, pivots)
        for ids, x, far in _blocks(batches, dim):
            cluster, best = assigner.nearest(x, far)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(cluster.tolist(), pa.int32()), pa.array([str(d) for d in best.tolist()], pa.string()),
            ], names=["vec_id", "cluster", "d"])

    return run


def first_centroids(kept: DataFrame, count: int) -> list[list[int]]:
    """The ``count`` vectors with the smallest sha256 of ``1:<vec_id>``; equal ids in the order of their vectors."""
    chosen = kept.withColumn("h", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    return [list(r["x"]) for r in chosen.orderBy(F.col("h").asc_nulls_last(), "x").limit(count).select("x").collect()]


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every valid vector.

    Cases: vectors that are null, not of ``dim`` components, or hold null, NaN or infinite ones are dropped. With fewer
    vectors than ``count`` there are as many centroids as vectors. Equal centroids: the smaller number gets the vectors,
    the others stay empty and unchanged. Rows that repeat count each time. A null id sorts behind all others and stays
    null. A distance or sum beyond the range of longs is null, the assignment is exact all the same. Extra columns are
    ignored. An empty table gives no rows.
    """
    good = vectors.where(all_finite(F.col(vector_col)) & (F.size(vector_col) == dim))
    kept = good.select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col), FACTOR).alias("x"))
    spark = vectors.sparkSession
    centroids = first_centroids(kept, count)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    pivots = choose_pivots(centroids)
    blocks = freeze(map_batches(kept, _pack(pivots, dim), BLOCK_SCHEMA), "vector-blocks")
    for _ in range(rounds):
        found = sum_limbs(map_batches(blocks, _summer(centroids, pivots, dim), f"cluster int, at int, {LIMB_SCHEMA}"), "cluster", "at")
        centroids = [[found[c, i] // found[c, dim] for i in range(dim)] if found[c, dim] else old for c, old in enumerate(centroids)]
    labels = freeze(map_batches(blocks, _labeller(centroids, pivots, dim), "vec_id long, cluster int, d string"), "labels")
    discard(blocks)
    exact = F.col("d").cast("decimal(38,0)")
    sums = {r["cluster"]: r["s"] for r in labels.groupBy("cluster").agg(F.sum(exact).alias("s")).collect()}  # a row for each centroid
    every = None if None in sums.values() else sum(sums.values())
    fits = lambda v: None if v is None or v >= 1 << 63 else int(v)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    plan = spark.createDataFrame([(c, fits(sums[c]), fits(every), digests[c]) for c in sorted(sums)],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    distance = F.when(exact < F.lit(str(1 << 63)).cast("decimal(38,0)"), exact.cast("long"))
    return labels.select("vec_id", "cluster", distance.alias("distance")).join(F.broadcast(plan), "cluster").select(  # a row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
