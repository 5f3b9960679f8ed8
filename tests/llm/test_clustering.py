"""Clustering against assignments made one by one with Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from retailflow.llm import clustering, queries

TOP = (1 << 63) - 1


def integer(x):
    if abs(x) < 1e300:
        return max(-TOP - 1, min(TOP, math.floor(x * 1024)))
    return TOP if x > 0 else -TOP - 1


def usable(vector, dimensions):
    return vector is not None and len(vector) == dimensions and all(
        x is not None and math.isfinite(x) for x in vector
    )


def brute(rows, clusters=8, rounds=10, seed=3, dimensions=64):
    kept = [(i, [integer(x) for x in v]) for i, v in rows if usable(v, dimensions)]

    def order(row):
        number = "" if row[0] is None else row[0]
        return hashlib.sha256(f"{seed}:{number}".encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted(kept, key=order)[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((apart.index(min(apart)), min(apart)))
        return found

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for (_, v), (k, _) in zip(kept, assign(), strict=True):
            members[k].append(v)
        centroids = [
            [sum(x) // len(own) for x in zip(*own, strict=True)] if own else c
            for own, c in zip(members, centroids, strict=True)
        ]
    final = assign()
    inertia = [sum(min(d, TOP) for k, d in final if k == j) for j in range(len(centroids))]
    return sorted(
        repr((i, k, min(d, TOP), min(inertia[k], TOP), min(sum(inertia), TOP), centroids[k]))
        for (i, _), (k, d) in zip(kept, final, strict=True)
    )


def rows(frame):
    return sorted(repr(tuple(r)) for r in frame.collect())


def frame(spark, data):
    return spark.createDataFrame(
        [(i, v, 1, "x") for i, v in data], "vec_id long, embedding array<double>, v int, cluster string"
    )


@pytest.mark.parametrize("count", [1, 2, 3, 8, 50])
def test_search_finds_the_nearest(count):
    rng = np.random.default_rng(count)
    for spread in (2, 50, 4000):
        centroids = rng.integers(-spread, spread, (count, 5)).astype(float)
        centroids[-1] = centroids[0]  # a tie for every vector near it
        vectors = rng.integers(-spread, spread, (400, 5)).astype(float)
        tree = clustering.build_tree(centroids)
        cluster, best, measured = clustering.nearest(vectors, centroids, tree)
        apart = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (cluster == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()
        assert measured <= len(vectors) * count


def test_search_skips_far_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-1_000_000, 1_000_000, (64, 3)).astype(float)
    vectors = centroids[rng.integers(0, 64, 1000)] + rng.integers(-9, 9, (1000, 3))
    _, _, measured = clustering.nearest(vectors, centroids, clustering.build_tree(centroids))
    assert measured < 1000 * 32


def test_ties_copies_and_odd_vectors(spark):
    rng = random.Random(3)
    data = [(k, [rng.choice((-0.5, 0.0, 0.25, 1.0)) for _ in range(3)]) for k in range(150)]
    data += [(7, data[7][1]), (7, [0.1, 0.2, 0.3]), (None, [1.0, 1.0, 1.0]), (500, None)]
    data += [(501, []), (502, [1.0, 2.0]), (503, [1.0, None, 2.0]), (504, [1.0, math.nan, 2.0])]
    data += [(505, [math.inf, 0.0, 0.0]), (506, [1.0] * 4), (507, [-0.0001, 0.0, -1e-300])]
    assert rows(clustering.cluster_vectors(frame(spark, data), dimensions=3, rounds=4)) == brute(
        data, rounds=4, dimensions=3
    )


def test_hot_vector_and_empty_clusters(spark):
    data = [(k, [1.0, 2.0]) for k in range(300)] + [(400 + k, [k / 8, -k / 4]) for k in range(40)]
    assert rows(clustering.cluster_vectors(frame(spark, data), dimensions=2)) == brute(data, dimensions=2)


@pytest.mark.parametrize("size", [5e4, 1e13, 1e17, 1e301])
def test_large_components(spark, size):
    rng = random.Random(5)
    data = [(k, [rng.uniform(-size, size), rng.uniform(-1, 1)]) for k in range(30)]
    found = clustering.cluster_vectors(frame(spark, data), clusters=3, rounds=2, dimensions=2)
    assert rows(found) == brute(data, 3, 2, dimensions=2)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, count):
    data = [(k, [float(k), 1.0]) for k in range(count)] + [(99, None)]
    found = clustering.cluster_vectors(frame(spark, data), dimensions=2)
    assert rows(found) == brute(data, dimensions=2) and found.count() == count


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = queries.op11_clustering(spark, "/root/testdata/sf0.001").collect()
    assert len(data) == len(found) > 0
    wanted = []
    for text in brute(data):
        *numbers, centroid = eval(text)
        wanted.append((*numbers, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()))
    assert sorted(tuple(r) for r in found) == sorted(wanted)
