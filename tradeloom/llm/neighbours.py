"""Approximate nearest neighbours by permutations: which pivots a vector is nearest to, and in what order.

``build`` finds for every vector its ``PREFIX`` nearest of ``PIVOTS`` pivots, in order. The pivots are the
only part fitted on a sample, of bounded size; every row is indexed. ``search`` deals the vectors to
shards by a hash of their id and the queries to blocks of bounded size, so that a hot region or a vector
of many copies spreads over all shards and no task holds more than one shard and one block. In its task
a shard posts its vectors in inverted files, one a pivot. A query reads the files of its own pivots,
which gives its footrule distance to each vector posted there, reranks the nearest part of the shard
(``RERANK``, and all that tie with its last) by exact distance, and keeps its k best; a window picks the
best over all shards.

Ids that are null and vectors that are null, zero, of another dimension than most vectors (the smaller
one if two are as common) or hold null or non-finite parts take no part. Of rows that repeat an id the
smallest vector counts. Equal distances rank by the smaller id. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 256
PREFIX = 128
RERANK = 0.25
SHARD_ROWS = 20_000
LEAST_SHARD_ROWS = 500
BLOCK_QUERIES = 2_000


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector of doubles), one row an id."""
    parts = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    parts = parts.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    parts = parts.where(finite & F.exists("vector", lambda x: x != 0))
    common = parts.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    parts = parts.where(F.size("vector") == (common["size"] if common else 0))
    return parts.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points of a sample, each the farthest from those before it.

    Pivots that lie close together, as a sample of a crowded region does, would order all others alike.
    """
    if not len(sample):
        return sample
    chosen, distance = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < count and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def build(vectors: DataFrame, pivots: int = PIVOTS, prefix: int = PREFIX) -> DataFrame:
    """The index over ``usable`` vectors: vec_id, vector, near (numbers of the nearest pivots, in order)."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).select("vector").collect()
    points = _spread(np.array([r["vector"] for r in sample]), pivots)
    shared = vectors.sparkSession.sparkContext.broadcast(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            own = _matrix(batch.column("vector"))
            near = np.empty((0, 0), np.int32)
            if len(own):
                squares = (points**2).sum(1) - 2 * own @ points.T
                near = np.argsort(squares, axis=1, kind="stable")[:, :prefix].astype(np.int32)
            offsets = np.arange(len(own) + 1) * (near.shape[1] if len(own) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(near.ravel()))], ["vec_id", "vector", "near"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, near array<int>")


class InvertedFiles:
    """The vectors of a shard by pivot: who has the pivot in its prefix, and at which place."""

    def __init__(self, near: np.ndarray, pivots: int):
        self.rows, self.prefix = near.shape
        order = np.argsort(near.ravel(), kind="stable")
        self.owner, self.place = (order // self.prefix).astype(np.int32), (order % self.prefix).astype(np.int32)
        self.begin = np.searchsorted(near.ravel()[order], np.arange(pivots + 1))

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """The footrule distance to each vector; a pivot outside a prefix is at the place after its end.

        Every pivot that both prefixes hold, at places i and j, takes 2 * (prefix - max(i, j)) off the
        distance of two prefixes that share none.
        """
        files = [slice(self.begin[p], self.begin[p + 1]) for p in query]
        owners = np.concatenate([self.owner[f] for f in files])
        gains = np.concatenate([2 * (self.prefix - np.maximum(self.place[f], i)) for i, f in enumerate(files)])
        return self.prefix * (self.prefix + 1) - np.bincount(owners, gains, self.rows)


def _nearest(k: int, pivots: int, rerank: float):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            ids, own = vectors.column("vec_id").to_numpy(), _matrix(vectors.column("vector"))
            files = InvertedFiles(_matrix(vectors.column("near")), pivots)
            wanted = min(len(ids), k + 1 + int(np.ceil(rerank * len(ids))))
            for query, vector, near in zip(queries.column("vec_id").to_numpy(), _matrix(queries.column("vector")), _matrix(queries.column("near")), strict=True):
                distance = files.footrule(near)
                # What ties at the cut is as near as what is inside, so all of it is reranked.
                at = np.flatnonzero(distance <= np.partition(distance, wanted - 1)[wanted - 1])
                at = at[ids[at] != query]
                exact = np.sqrt(((own[at] - vector) ** 2).sum(1))
                best = np.lexsort((ids[at], exact))[:k]
                found.append((np.full(len(best), query), ids[at][best], exact[best]))
        columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0) for i in range(3)]
        return pa.table([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(float))], ["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, rerank: float = RERANK) -> DataFrame:
    """The k nearest found of each query (rows of the index): query_id, rank, vec_id, score.

    A query's own id is no candidate of it. With fewer candidates than k, all are returned.
    """
    rows, asked = index.count(), queries.count()
    parallel = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Each query returns k rows from every shard, so there are no more shards than work for the cores needs.
    shards = max(1, -(-rows // SHARD_ROWS), min(parallel, -(-rows // LEAST_SHARD_ROWS)))
    parts = max(1, -(-asked // BLOCK_QUERIES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = index.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")).withColumn("block", numbers(parts))
    asking = queries.select("*", F.pmod(F.xxhash64("vec_id", F.lit("q")), F.lit(parts)).cast("int").alias("block")).withColumn("shard", numbers(shards))
    near = dealt.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInArrow(_nearest(k, pivots, rerank), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
