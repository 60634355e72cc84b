"""Approximate nearest neighbours by cosine (operator 2).

Distinct vectors are dealt to shards by hash; each shard builds a robust-pruned
graph (``graph_index``), every query beam-searches every shard, and the best of all
shards are merged. A shard is the only thing held in memory: its vectors come first
in its partition, then the queries stream past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genenet_spark.llm.common import freeze, map_batches
from genenet_spark.llm.graph_index import GraphIndex

SHARD_VECTORS = 4096
SEARCH_BEAM = 96
QUERY_BATCH = 256


def _valid(vector: str) -> str:
    return (f"{vector} IS NOT NULL AND size({vector}) > 0 AND forall({vector}, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))"
            f" AND exists({vector}, v -> v <> 0)")


class _Shard:
    def __init__(self, vectors: list, ids: list):
        self.vectors, self.ids = np.array(vectors, np.float64), ids
        # Scaled first, so that no square leaves the range of doubles.
        self.scaled = self.vectors / np.abs(self.vectors).max(axis=1, keepdims=True)
        self.norm = np.linalg.norm(self.scaled, axis=1)
        self.index = GraphIndex(self.scaled)

    def nearest(self, query_ids: list, queries: list, k: int, beam: int) -> list[tuple[int, int, float]]:
        q = np.array(queries, np.float64)
        q /= np.abs(q).max(axis=1, keepdims=True)
        norm = np.linalg.norm(q, axis=1)
        found, _ = self.index.search(q / norm[:, None], beam)
        out = []
        for i, own in enumerate(query_ids):
            at = found[i][found[i] >= 0]
            cos = (self.scaled[at] @ q[i]) / (self.norm[at] * norm[i])
            hits = sorted((-c, v) for c, j in zip(cos.tolist(), at.tolist()) for v in self.ids[j] if v != own)
            out += [(own, v, -c) for c, v in hits[:k]]
        return out


def _searcher(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vectors, ids, shard = None, [], [], None
        waiting: list[tuple[int, list]] = []

        def answer() -> pa.RecordBatch:
            rows = shard.nearest([w[0] for w in waiting], [w[1] for w in waiting], k, beam)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array([r[2] for r in rows], pa.float64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for number, query, vector, same in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if number != now:
                    if waiting:
                        yield answer()
                    now, vectors, ids, shard = number, [], [], None
                if query is None:
                    vectors.append(vector)
                    ids.append(same)
                    continue
                if not vectors:
                    continue
                shard = shard or _Shard(vectors, ids)
                waiting.append((query, vector))
                if len(waiting) == QUERY_BATCH:
                    yield answer()
        if waiting:
            yield answer()

    return run


def search(vectors: DataFrame, query_every: int = 50, k: int = 5, shard_vectors: int = SHARD_VECTORS, beam: int = SEARCH_BEAM,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows found for each row whose id is divisible by ``query_every``.

    ``score`` is the cosine of the original vectors in double precision; ties go to the smaller id.

    Cases: vectors that are null, empty, zero or hold null, NaN or infinite components take no part, nor do
    rows of null id; vectors are compared with those of their own length only; an id that repeats counts once,
    with its least vector; vectors that are equal once divided by their largest component are one point of the graph that
    keeps its ``k + 1`` smallest ids, as no other can be among the nearest; extra columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where("vec_id IS NOT NULL").where(_valid("vector")).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = freeze(rows, "vectors")
    # Vectors of one direction have the same cosines; scores are taken from the scaled vector, so it stands for all of them.
    largest = F.array_max(F.transform("vector", lambda c: F.abs(c)))
    directions = rows.withColumn("m", largest).select("vec_id", F.transform("vector", lambda c: c / F.col("m")).alias("vector"))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    points = directions.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("same"))
    points = freeze(points, "points")
    # Shards of each vector length; lengths are few (a row each).
    shards, total = [], 0
    for r in points.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        count = -(-r["n"] // shard_vectors)
        shards.append((r["dim"], count, total))
        total += count
    plan = rows.sparkSession.createDataFrame(shards, "dim int, shards int, first int")
    base = points.join(F.broadcast(plan), F.size("vector") == F.col("dim")).select(  # a row for each vector length
        (F.col("first") + F.pmod(F.xxhash64("vector"), F.col("shards"))).cast("int").alias("shard"),
        F.lit(None).cast("long").alias("query"), "vector", "same")
    asked = rows.where(F.col("vec_id") % query_every == 0).join(F.broadcast(plan), F.size("vector") == F.col("dim")).select(
        F.explode(F.sequence("first", F.col("first") + F.col("shards") - 1)).alias("shard"), F.col("vec_id").alias("query"), "vector",
        F.lit(None).cast("array<bigint>").alias("same"))
    dealt = base.unionByName(asked).repartitionByRange(max(1, total), "shard").sortWithinPartitions("shard", F.col("query").asc_nulls_first())
    found = map_batches(dealt, _searcher(k, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
