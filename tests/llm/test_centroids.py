import random
from hashlib import sha256
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.errors import PythonException

from matchlake.llm.centroids import Bisectors, cluster_vectors, op13_centroids


def brute(rows, dim, k, rounds, scale=256, seed=2):
    kept = [(i, [floor(scale * x) for x in v]) for i, v in rows if v and len(v) == dim and all(x is not None and isfinite(x) for x in v)]
    named = sorted((sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centroids = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        for n, xs in members.items():
            centroids[n] = [sum(column) // len(xs) for column in zip(*xs)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept] if centroids else []
    inertia = {}
    for _, n, d in found:
        inertia[n] = inertia.get(n, 0) + d
    return [(i, n, d, inertia[n], sum(inertia.values()), centroids[n]) for i, n, d in found]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *(x or 0 for x in r[:3])))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = [(*r[:5], sha256(",".join(map(str, r[5])).encode()).hexdigest()) for r in brute(rows, 64, 40, 5)]
    found = [tuple(r) for r in op13_centroids(spark, sf_dir).collect()]
    assert in_order(found) == in_order(expected)


def test_tournament_takes_the_nearest_and_the_smaller_number():
    draw = np.random.RandomState(3)
    centroids = draw.randint(-3, 4, (25, 3))
    centroids[7] = centroids[3]
    x = draw.randint(-4, 5, (2000, 3))
    distances = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    bisectors = Bisectors.of(centroids)
    assert (bisectors.nearest(x) == distances.argmin(axis=1)).all()
    assert (bisectors.distances(x, distances.argmin(axis=1)) == distances.min(axis=1)).all()


def test_odd_rows(spark):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [nan, 0.0, 0.0]), (105, [0.0, inf, 0.0])]
    rows += [(7, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5]), (8, [-9.0, 1e4, 0.0]), (None, [0.25, 0.0, -0.25]), (None, [0.25, 0.0, -0.25])]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "vec_id long, embedding array<double>, vector string, cluster int, place int")
    found = [tuple(r) for r in cluster_vectors(df.repartition(7), dim=3, k=6, rounds=3).collect()]
    assert in_order(found) == in_order(brute(rows, 3, 6, 3))
    assert cluster_vectors(df.limit(0), dim=3).count() == 0
    assert cluster_vectors(df.filter("vec_id > 99"), dim=3).count() == 0


def test_fewer_vectors_than_clusters_and_equal_ones(spark):
    rows = [(i, [float(i // 2), 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert in_order(tuple(r) for r in cluster_vectors(df, dim=2, k=40).collect()) == in_order(brute(rows, 2, 40, 5))


def test_components_beyond_exact_distances_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises((PythonException, ValueError)):
        cluster_vectors(df, dim=2).collect()
