"""Approximate nearest neighbours by a forest of sorted hash strings.

Each tree hashes a vector to a long string of bits, signs of random projections, and keeps the strings
sorted. A query descends in every tree to its longest matching prefix, then ascends in all trees at
once, bit by bit, taking in whatever shares the shorter prefix in any tree, until it has enough
candidates; those are measured exactly. The index is cut into shards of bounded size by a hash of the
vector's id; each shard holds its own forest, every query block visits every shard, and the shards'
best are merged. Equal vectors are indexed once, with as many of their smallest ids as a result can show.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.llm.common import pieces, shipped

NEAREST = 10
TREES = 256
#: Trees hashed together.
HASHED = 32
BITS = 24
SHARD_ROWS = 8192
QUERY_ROWS = 256
#: Share of a shard that a query takes as candidates at least, before the rest of the level it has come to.
SHARE = 0.2
#: Candidates of a shard at least, if it has so many.
LEAST = 768
SEED = 2


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of double) of the rows that have an id and a vector that is neither empty nor
    zero and holds no NULL, NaN or infinite component."""
    v = F.col("v")
    return vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))


class Forest:
    """Of the rows of points: their hash strings, in order, for each tree."""

    def __init__(self, points: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng([seed, points.shape[1]])
        self.points, self.trees, self.bits = points, trees, bits
        self.planes = rng.standard_normal((points.shape[1], trees * bits))
        hashes = self.hashed(points)
        self.order = np.argsort(hashes, axis=0, kind="stable").astype(np.int32)
        self.strings = np.take_along_axis(hashes, self.order, 0)

    def hashed(self, vectors: np.ndarray) -> np.ndarray:
        places = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        strings = np.empty((len(vectors), self.trees), np.int64)
        for t in range(0, self.trees, HASHED):
            signs = vectors @ self.planes[:, t * self.bits: (t + HASHED) * self.bits] > 0
            strings[:, t: t + HASHED] = signs.reshape(len(vectors), -1, self.bits) @ places
        return strings

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query, tree and prefix length from 0 to bits: where the strings that share it begin and end."""
        strings = self.hashed(queries)
        free = self.bits - np.arange(self.bits + 1)  # bits after the prefix
        low = (strings[:, :, None] >> free) << free
        high = low + (1 << free)
        find = lambda x: np.stack([np.searchsorted(self.strings[:, t], x[:, t]) for t in range(self.trees)], 1)
        return find(low), find(high)

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query, the rows met by the level at which they are enough."""
        begins, ends = self.ranges(queries)
        for low, high, sizes in zip(begins, ends, (ends - begins).sum(1), strict=True):
            found = np.zeros(len(self.points), bool)
            for level in range(self.bits, -1, -1):
                if level == 0:
                    found[:] = True
                elif sizes[level] >= enough:  # with fewer, met rows told apart can't be enough; the next level has them too
                    for t in np.flatnonzero(high[:, level] > low[:, level]):
                        found[self.order[low[t, level]: high[t, level], t]] = True
                    if np.count_nonzero(found) >= enough:
                        break
            yield np.flatnonzero(found)


def _nearest(forest: Forest, ids: list[np.ndarray], query_ids: np.ndarray, queries: np.ndarray, nearest: int, share: float):
    """query, id and distance of each query's nearest in a shard; the query itself is no neighbour."""
    enough = min(len(forest.points), max(LEAST, 4 * nearest, int(np.ceil(share * len(forest.points)))))
    for query, own, rows in zip(query_ids, queries, forest.candidates(queries, enough), strict=True):
        distance = np.sqrt(((forest.points[rows] - own) ** 2).sum(1))
        limit = np.partition(distance, min(nearest, len(rows) - 1))[min(nearest, len(rows) - 1)]
        best = [(d, i) for d, r in zip(distance[distance <= limit], rows[distance <= limit], strict=True) for i in ids[r] if i != query]
        for d, i in sorted(best)[:nearest]:
            yield query, i, d


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST,
           trees: int = TREES, bits: int = BITS, share: float = SHARE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance, double) of the nearest found rows
    of vectors to each row of queries, other than the row of the query's id.

    Rows without an id, and vectors that are NULL, zero, or hold NULL or non-finite components, take no
    part; vectors of another length than the query's aren't near it. Ties go to the smaller id. Rows of
    one id and one vector count once. A query with fewer candidates gets them all. Ids of rows with
    different vectors should differ."""
    shipped(vectors.sparkSession)
    points = usable(vectors, id_col, vector_col)
    # a result shows nearest rows other than the query: the smallest nearest + 1 ids of a vector do
    first = Window.partitionBy("v").orderBy("id")
    once = points.distinct().withColumn("turn", F.row_number().over(first)).filter(F.col("turn") <= nearest + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("id")).alias("ids"))
    n = points.count()
    shards = pieces(n, shard_rows)
    index = once.select(
        F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("width"),
        F.lit(-1).alias("block"), F.col("ids"), F.col("v"))
    asked = usable(queries, id_col, vector_col).distinct()
    blocks = pieces(asked.count(), QUERY_ROWS)
    packed = asked.groupBy(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.size("v").alias("width")).agg(
        F.sort_array(F.collect_list(F.struct("id", "v"))).alias("q"))
    sent = packed.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "width", "block",
        F.col("q.id").alias("ids"), F.flatten("q.v").alias("v"))
    met = index.unionByName(sent).repartition(max(shards, 1), "shard", "width").sortWithinPartitions("shard", "width", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, forest, parts, ids = None, None, [], []
        for b in batches:
            keys = list(zip(b["shard"].to_pylist(), b["width"].to_pylist(), b["block"].to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                key = keys[at][:2]
                if key != now:
                    now, forest, parts, ids = key, None, [], []
                if keys[at][2] < 0:
                    end = at
                    while end < len(keys) and keys[end] == (*key, -1):
                        end += 1
                    part = b.slice(at, end - at)
                    parts.append(part["v"].flatten().to_numpy().reshape(-1, key[1]))
                    ids += part["ids"].to_pylist()
                    at = end
                    continue
                if parts:  # queries without rows of their width in this shard find none
                    forest = forest or Forest(np.concatenate(parts), trees, bits)
                    own = np.array(b["v"][at].as_py()).reshape(-1, key[1])
                    found = list(_nearest(forest, ids, np.array(b["ids"][at].as_py()), own, nearest, share))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                         pa.array([f[2] for f in found], pa.float64())], ["query_id", "vec_id", "score"])
                at += 1

    near = met.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")
