"""Centroid clustering of integer vectors; the nearest centroid is found by a tournament of bisectors.

Between two centroids a < b stands their bisector. A vector x is nearer to b if and only if
2 (b - a) . x > |b|^2 - |a|^2, so a whole-number normal and threshold, worked out once for each pair, decide by one linear test. The
champion meets the other centroids in ascending order, and each test eliminates one of the two: k - 1 tests leave the nearest. The
champion always has the smaller number and stays at equality. Only the last distance is computed in full.

All arithmetic is in whole numbers, so the result does not depend on how rows lie in partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import table

# Components of this size keep all tests and distances within 64 bits, at up to MAX_DIM of them.
LIMIT, MAX_DIM = 1 << 26, 128
# Vectors that meet the tournament at once.
BATCH = 4096


@dataclass(frozen=True)
class Bisectors:
    """The centroids with the bisectors of all pairs: normals[a, b] . x > thresholds[a, b] says that b is nearer."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        squares = (centroids**2).sum(axis=1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), squares[None] - squares[:, None])

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row, the smaller one of equally near ones."""
        champion = np.zeros(len(x), np.int64)
        for other in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", self.normals[champion, other], x) - self.thresholds[champion, other]
            champion[side > 0] = other
        return champion

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return ((x - self.centroids[cluster]) ** 2).sum(axis=1)


def is_whole(vector: Column, dim: int) -> Column:
    """Whether a vector has `dim` components, none of them null, NaN or infinite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == dim) & F.forall(vector, number), F.lit(False))


def _integers(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * component) of vectors that are whole."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    scaled = np.floor(scale * flat)
    if np.abs(scaled).max(initial=0) >= LIMIT:
        raise ValueError(f"components must be less than {LIMIT // scale} in size")
    return scaled.astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part.column("vec_id"), _integers(part.column("vector"), dim, scale)


def assigned(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(vec_id, cluster, distance) for each row of (vec_id, vector)."""
    dim = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors.of(centroids)
        for ids, x in _batches(batches, dim, scale):
            cluster = bisectors.nearest(x)
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(bisectors.distances(x, cluster))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "vector").mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, by component; those without vectors stay.

    A task hands on one row for each of its clusters. Only the sums, k times dim numbers, come to the driver.
    """
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors.of(centroids)
        sums, counts = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for _, x in _batches(batches, dim, scale):
            cluster = bisectors.nearest(x)
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            sums[present] += np.add.reduceat(x[order], first)
        rows = [(i, j, str(sums[i, j]), counts[i]) for i in np.flatnonzero(counts) for j in range(dim)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], ["cluster", "place", "part", "n"])

    parts = vectors.select("vec_id", "vector").mapInArrow(add, "cluster long, place long, part string, n long")
    totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    after = centroids.copy()
    for row in totals.collect():
        after[row.cluster, row.place] = int(row.total) // row.n
    return after


def first_centroids(vectors: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The k vectors with the least sha256 of `seed:vec_id`; all of them if there are fewer. Vectors without id are not taken."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.filter("vec_id IS NOT NULL").select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k)
    rows = [row.vector for row in chosen.collect()]
    return _integers(pa.array(rows), len(rows[0]), scale) if rows else np.empty((0, 0), np.int64)


def cluster_vectors(
    embeddings: DataFrame, vector: str = "embedding", dim: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) for each vector of `dim` numbers.

    Vectors of other length, null ones, and those with a null, NaN or infinite component are left out. Components become
    floor(scale * x); scaled ones of LIMIT or more in size raise an error, as distances would leave 64 bits. Rows that repeat count each on
    their own; rows without id are clustered, but begin no cluster. With fewer than k vectors with an id there are as many clusters as
    there are such vectors, and with none the result is empty. Other columns are ignored.

    The table is read once for each round and twice after them; nothing of it is shuffled or sent to the driver
    but k sums for each task.
    """
    if dim > MAX_DIM:
        raise ValueError(f"at most {MAX_DIM} components")
    vectors = embeddings.select("vec_id", F.col(vector).cast("array<double>").alias("vector")).filter(is_whole(F.col("vector"), dim))
    centroids = first_centroids(vectors, k, seed, scale)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(vectors, centroids, scale)
    else:
        centroids, vectors = np.zeros((1, dim), np.int64), vectors.limit(0)
    rows = assigned(vectors, centroids, scale)
    sums = {row.cluster: row.inertia for row in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    facts = [(i, sums.get(i, 0), sum(sums.values()), c.tolist()) for i, c in enumerate(centroids)]
    # k rows: the bound of what goes to all tasks.
    known = F.broadcast(embeddings.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>"))
    return rows.join(known, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of the vectors of `embeddings`; odd rows as in `cluster_vectors`."""
    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


def _oracle(k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2) -> str:
    """Plain nearest-centroid rounds, one after another."""
    square = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

    def nearest(number: int) -> str:
        return (
            f"near{number} AS MATERIALIZED (SELECT rid, any_value(x) AS x, min((d, i)) AS best "
            f"FROM (SELECT rid, x, i, {square} AS d FROM kept, c{number}) GROUP BY rid)"
        )

    steps = []
    for n in range(rounds):
        steps.append(nearest(n))
        steps.append(
            f"c{n + 1} AS MATERIALIZED (SELECT c{n}.i, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN ("
            f"SELECT i, list(v ORDER BY place) AS c FROM (SELECT best[2] AS i, place, "
            f"CAST(floor(sum(x[place])::DOUBLE / count(*)) AS BIGINT) AS v "
            f"FROM near{n}, range(1, 65) p(place) GROUP BY ALL) GROUP BY i) m USING (i))"
        )
    steps.append(nearest(rounds))
    return f"""
WITH whole AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(e, lambda v: CAST(floor({scale} * v) AS BIGINT)) AS x FROM whole),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS i, x AS c FROM kept
    ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}),
{", ".join(steps)}
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
    CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
    CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.c, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (rid) JOIN c{rounds} ON c{rounds}.i = best[2]
"""


ORACLE_SQL = _oracle()
