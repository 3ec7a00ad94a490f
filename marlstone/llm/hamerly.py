"""Exact k-means over integer vectors with Hamerly's bounds.

Every vector keeps an upper bound of the distance to its centroid and one lower bound of the
distance to any other. After centroids moved, the upper bound grows by the drift of the own
centroid and the lower one shrinks by the largest drift of another. A vector whose upper
bound is still below its lower bound (or below half the way from its centroid to the next)
keeps its cluster unread; the others are held against all centroids in integers, where ties
go to the smaller number. Bounds are floating point and only decide what is scanned, with
room for rounding; distances, sums and centroids are integers.

Vectors and bounds are a table in the shared folder that each round reads once and writes
once. The driver holds the centroids (k times the dimension) and their sums; a round adds
to the sums only what vectors brought that changed their cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import new_path, remove

#: Components are at most this large, so that squared distances of up to 64 of them fit a long.
LARGEST = 1 << 27
#: Vectors held against all centroids at a time.
BLOCK = 1024


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, size: int, scale: float) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as a double. Vectors with another
    number of components, a null or a component that isn't finite are left out."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    rows = rows.select(F.col(f"`{id_col}`").alias("vec_id"), x.alias("x")).where(F.size("x") == size)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = rows.where(~F.exists("x", bad))
    large = F.exists("x", lambda c: F.abs(F.floor(c * scale)) > LARGEST)
    return rows.select("vec_id", F.when(large, F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling"))).otherwise(F.transform("x", lambda c: F.floor(c * scale).cast("int"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors of smallest SHA-256 of ``seed:vec_id`` (a null id: the text null); equal
    ids by their components. Fewer vectors are all centroids."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return np.array([r.v for r in vectors.orderBy(order, "v").limit(k).collect()], np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all centroids, in integers."""
    square = lambda a: np.einsum("ij,ij->i", a, a)
    return square(vectors)[:, None] + square(centroids)[None, :] - 2 * (vectors @ centroids.T)


class Bounds:
    """One round's centroids, how far each moved, and half the way to its nearest other."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.centroids, k = centroids, len(centroids)
        between = distances(centroids, centroids)
        np.fill_diagonal(between, np.iinfo(np.int64).max)
        self.half = np.sqrt(between.min(axis=1)) / 2 if k > 1 else np.full(k, np.inf)
        self.drift = np.zeros(k) if before is None else np.sqrt(((centroids - before) ** 2).sum(axis=1))
        ranked = np.argsort(-self.drift, kind="stable")
        self.other = np.full(k, self.drift[ranked[0]])  # the largest drift of another centroid
        self.other[ranked[0]] = self.drift[ranked[1]] if k > 1 else 0.0

    def assign(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Cluster, upper and lower bound of each vector, and how many were scanned. A
        cluster of -1 is one not known yet."""
        cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
        known = np.flatnonzero(cluster >= 0)
        own = cluster[known]
        upper[known] += self.drift[own]
        lower[known] -= self.other[own]
        reach = np.maximum(lower[known], self.half[own])
        open_ = known[~self._below(upper[known], reach)]
        if len(open_):  # the own distance first: often it is enough
            own = cluster[open_]
            upper[open_] = np.sqrt(((vectors[open_] - self.centroids[own]) ** 2).sum(axis=1))
            open_ = open_[~self._below(upper[open_], np.maximum(lower[open_], self.half[own]))]
        open_ = np.concatenate([open_, np.flatnonzero(cluster < 0)])
        for at in range(0, len(open_), BLOCK):
            part = open_[at : at + BLOCK]
            d = distances(vectors[part], self.centroids)
            cluster[part] = best = d.argmin(axis=1)  # the first of equals
            rows = np.arange(len(part))
            upper[part] = np.sqrt(d[rows, best])
            d[rows, best] = np.iinfo(np.int64).max
            lower[part] = np.sqrt(d.min(axis=1)) if d.shape[1] > 1 else np.inf
        return cluster, upper, lower, len(open_)

    @staticmethod
    def _below(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + 1e-9 * (1.0 + a) < b


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _assigned(state: DataFrame, bounds: Bounds, size: int) -> DataFrame:
    """The next state: was is the cluster before."""
    kind = state.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, v, cluster, upper, lower = batch.columns[:5]
                before = cluster.to_numpy(zero_copy_only=False)
                after, high, low, _ = bounds.assign(_matrix(v, size), before, upper.to_numpy(zero_copy_only=False), lower.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([ids, v, pa.array(after, pa.int32()), pa.array(high), pa.array(low), pa.array(before, pa.int32())], names=["vec_id", "v", "cluster", "upper", "lower", "was"])

    return state.select("vec_id", "v", "cluster", "upper", "lower").mapInArrow(run, f"vec_id {kind}, v array<int>, cluster int, upper double, lower double, was int")


def _moved(state: DataFrame, size: int) -> list:
    """Per cluster the number and the sums of vectors that came, less those that left."""
    went = state.where("cluster <> was")
    ways = went.select("v", F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("s")))).alias("w"))
    ways = ways.where("w.c >= 0")
    return ways.groupBy("w.c").agg(F.sum("w.s").alias("n"), F.array(*[F.sum(F.get("v", i).cast("bigint") * F.col("w.s")) for i in range(size)]).alias("sums")).collect()


def fit(rows: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: float = 256.0, seed: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray, str]:
    """(vec_id, v, cluster, ...) after the last assignment, the final centroids, and the path
    of that table for the caller to remove.

    Repeated rows are vectors of their own. A cluster that lost all vectors keeps its
    centroid. Of fewer than k vectors each is a centroid; without any the table is empty.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, id_col, vector_col, size, scale)
    centroids = first_centroids(vectors, k, seed).reshape(-1, size)
    unknown = [F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"), F.lit(-1).alias("was")]
    state, path, before = vectors.select("vec_id", "v", *unknown), "", None
    counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for number in range(rounds + 1):
        new = new_path(spark, "clusters")
        (_assigned(state, Bounds(centroids, before), size) if len(centroids) else state.limit(0)).write.parquet(new)
        if path:
            remove(spark, path)
        path, state = new, _read(spark, new, state)
        if number < rounds and len(centroids):
            for r in _moved(state, size):
                counts[r.c] += r.n
                sums[r.c] += np.array(r.sums, np.int64)
            full = counts > 0
            before, centroids = centroids, centroids.copy()
            centroids[full] = sums[full] // counts[full, None]
    return state, centroids, path


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    kind = like.schema["vec_id"].dataType.simpleString()
    return spark.read.schema(f"vec_id {kind}, v array<int>, cluster int, upper double, lower double, was int").parquet(path)


def clusters(rows: DataFrame, **options) -> DataFrame:
    """A row per vector: vec_id, cluster, distance (squared, to its centroid),
    cluster_inertia and inertia (distances summed over the cluster and over all), and the
    SHA-256 of the centroid's components as decimal numbers joined by commas. Options and
    cases as for fit()."""
    state, centroids, _ = fit(rows, **options)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # k rows, so a broadcast of stated size
    table = rows.sparkSession.createDataFrame([(i, c, s) for i, (c, s) in enumerate(zip(centroids.tolist(), shas, strict=True))], "cluster int, c array<bigint>, centroid_sha256 string")
    square = F.aggregate(F.zip_with("v", "c", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    found = state.select("vec_id", "v", "cluster").join(F.broadcast(table), "cluster").select("vec_id", "cluster", square.alias("distance"), "centroid_sha256")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia = rows.sparkSession.createDataFrame([(r.cluster, r.cluster_inertia, sum(x.cluster_inertia for x in sums)) for r in sums], "cluster int, cluster_inertia bigint, inertia bigint")
    return found.join(F.broadcast(inertia), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
