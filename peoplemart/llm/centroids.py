"""Clusters around centroids, by dictionaries of subvectors.

Vectors of integers are cut into blocks of a few dimensions. In a run of rows each block's distinct subvectors are
written once, as a dictionary, and a vector is its blocks' codes; nothing is lost. In a round the squared distances of
every subvector of a dictionary to the centroids are computed once, and a vector's distances are the sums of those that
its codes name. Runs are rows of a table, so dictionaries stay small whatever values occur, and all that leaves a task
in a round are the sums of its clusters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplemart.llm.common import checkpointed, packed, shipped, unpacked

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
BLOCK = 2
SCALE = 256
RUN_ROWS = 8192
#: Integers beyond stand at this bound, so that squared distances fit 64 bits.
BOUND = 1 << 26
_WIDE = "decimal(38,0)"

_ENCODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("no_id", T.BinaryType()),
                         T.StructField("codes", T.ArrayType(T.BinaryType())), T.StructField("words", T.ArrayType(T.BinaryType()))])


def integers(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """floor(256 x) of each component x, as an array of long; NULL unless there are so many, all finite."""
    whole = vector.cast("array<double>")
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when((F.size(whole) == dimensions) & ~odd, F.transform(whole, lambda x: F.greatest(
        F.lit(-BOUND).cast("double"), F.least(F.lit(BOUND).cast("double"), F.floor(x * SCALE).cast("double"))).cast("long")))


def dictionary(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the rows, and the distinct row of each code."""
    key = np.zeros(len(vectors), np.int64)
    for column in vectors.T:
        distinct, own = np.unique(column, return_inverse=True)
        first, key = np.unique(key * len(distinct) + own, return_index=True, return_inverse=True)[1:]
    return key, np.ascontiguousarray(vectors[first])


def encoded(rows: DataFrame, dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """rows (vec_id long, v array of long) in runs: ids, and for each block the codes of the rows and the dictionary."""
    shipped(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), RUN_ROWS):
                part = batch.slice(begin, RUN_ROWS)
                ids = part["vec_id"]
                vectors = np.asarray(part["v"].flatten(), np.int32).reshape(-1, dimensions)
                codes, words = [], []
                for at in range(0, dimensions, block):
                    which, distinct = dictionary(vectors[:, at: at + block])
                    codes.append(packed(which.astype(np.uint16)))
                    words.append(packed(distinct.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([packed(np.asarray(ids.fill_null(0), np.int64))]), pa.array([packed(np.asarray(ids.is_null().cast(pa.uint8())))]),
                     pa.array([codes], pa.list_(pa.binary())), pa.array([words], pa.list_(pa.binary()))], _ENCODED.names)

    return rows.select("vec_id", "v").mapInArrow(run, _ENCODED)


def nearest(codes: list[np.ndarray], words: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector of a run the nearest centroid (of several, the first) and its squared distance."""
    total, at = np.zeros((len(codes[0]), len(centroids)), np.int64), 0
    for which, distinct in zip(codes, words, strict=True):
        width = distinct.shape[1]
        apart = distinct[:, None, :] - centroids[None, :, at: at + width]
        total += np.einsum("dcw,dcw->dc", apart, apart)[which]
        at += width
    cluster = total.argmin(1)
    return cluster, total[np.arange(len(total)), cluster]


def _runs(batch: pa.RecordBatch, dimensions: int, block: int) -> Iterator[tuple[pa.Array, list[np.ndarray], list[np.ndarray]]]:
    """ids, codes and dictionaries of each run."""
    widths = [min(block, dimensions - at) for at in range(0, dimensions, block)]
    for row in batch.to_pylist():
        ids = pa.array(unpacked(row["ids"], np.int64), mask=unpacked(row["no_id"], np.uint8).astype(bool))
        words = [unpacked(w, np.int32).astype(np.int64).reshape(-1, width) for w, width in zip(row["words"], widths, strict=True)]
        yield ids, [unpacked(c, np.uint16) for c in row["codes"]], words


def _mapped(runs: DataFrame, schema: str, each: Callable[..., pa.RecordBatch], dimensions: int, block: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _runs(batch, dimensions, block):
                yield each(*own)

    return runs.mapInArrow(run, schema)


def moved(runs: DataFrame, centroids: np.ndarray, dimensions: int = DIMENSIONS, block: int = BLOCK) -> np.ndarray:
    """The centroids after a round: each the mean of its vectors, rounded down; one without vectors stays."""
    def sums(ids: pa.Array, codes: list[np.ndarray], words: list[np.ndarray]) -> pa.RecordBatch:
        cluster, _ = nearest(codes, words, centroids)
        found = np.zeros((len(centroids), dimensions), np.int64)
        np.add.at(found, cluster, np.concatenate([w[c] for c, w in zip(codes, words, strict=True)], 1))
        number = np.bincount(cluster, minlength=len(centroids))
        own = np.flatnonzero(number)
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(number[own].astype(np.int64)),
                                           pa.array(found[own].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    found = _mapped(runs, "cluster int, n long, sums array<long>", sums, dimensions, block).groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dimensions)])
    after = centroids.copy()
    for row in found.collect():  # one row a centroid
        after[row.cluster] = [row[f"s{i}"] // row.n for i in range(dimensions)]
    return after


def assigned(runs: DataFrame, centroids: np.ndarray, dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster and distance (squared) of each vector."""
    def each(ids: pa.Array, codes: list[np.ndarray], words: list[np.ndarray]) -> pa.RecordBatch:
        cluster, distance = nearest(codes, words, centroids)
        return pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return _mapped(runs, "vec_id long, cluster int, distance long", each, dimensions, block)


def first_centroids(rows: DataFrame, clusters: int, dimensions: int) -> np.ndarray:
    """The vectors of least hash, of their ids; vectors without an id come last, equal ids go by their vectors."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(order.alias("at"), "v").orderBy(F.col("at").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([row.v for row in first], np.int64).reshape(-1, dimensions)


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
              rounds: int = ROUNDS, dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector of so many dimensions.

    Vectors that are NULL, of other length, or hold NULL or non-finite components take no part. Components become
    integers floor(256 x), those beyond 2^26 stand at it. Ties go to the smaller cluster. With fewer vectors than
    clusters each is a centroid of its own; a cluster that has no vector keeps its centroid. Repeated rows, or rows
    without an id, are vectors of their own. An empty table gives no rows; other columns, whatever their names, are not read."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), integers(vectors[vector_col], dimensions).alias("v")).filter("v IS NOT NULL")
    runs = checkpointed(encoded(rows, dimensions, block))
    centroids = first_centroids(rows, clusters, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(runs, centroids, dimensions, block)
    found = checkpointed(assigned(runs, centroids, dimensions, block))
    own = {row.cluster: int(row.own) for row in found.groupBy("cluster").agg(  # one row a centroid
        F.sum(F.col("distance").cast(_WIDE)).alias("own")).collect()}
    each = spark.createDataFrame(
        [(i, own.get(i, 0), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(own.values())).cast("long").alias("inertia"), "centroid_sha256")
