"""Centroid clustering with a vantage-point tree over the centroids (operator 11).

Vectors are integers, so every distance, sum and quotient is exact. Each round builds a
vantage-point tree over the centroids and broadcasts it: a node is a centroid, and its two
children hold the nearer and the farther half of the others, each with the least and greatest
distance from the node. A vector is assigned by best-first search: it visits the waiting node of
least lower bound, measures the node's centroid exactly, and goes on while a bound is within the
radius of the best centroid so far. The radius is inclusive and the bounds, the only inexact
numbers, are lowered by more than their error, so centroids as near as the best are visited too,
and the smaller number wins. A task runs the searches of many vectors side by side.

A task sends its sums of each cluster, one row per centroid, so a cluster with a third of all
vectors is a few rows by then. The driver gets one count and one sum for each centroid and
component. Both are bounded by the number of centroids, as is the tree: nothing else grows.
The vectors are written to the shared folder once and read each round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from retailflow.llm.common import stored

DIMENSIONS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3

#: Components up to this size make distances that are exact in floating point; larger ones are
#: Python integers.
EXACT = 1 << 22
#: Numbers in the table of bounds of the vectors that are searched at a time.
TABLE = 1 << 20
#: By how much bounds are lowered, in parts of the distances they are made of.
SLACK = 1e-9
#: Greater distances and inertias are given as this.
GREATEST = (1 << 63) - 1


@dataclass
class Node:
    """A centroid, the first distance range and number of its children, and theirs."""

    centroid: int
    children: tuple[tuple[int, float, float], ...]  # node, least and greatest distance


def _distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances, exact: floating point holds the integers, or they are Python's."""
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


def build_tree(centroids: np.ndarray) -> list[Node]:
    """The nodes of a balanced tree, the root first."""
    nodes: list[Node | None] = []

    def grow(members: list[int]) -> int:
        at = len(nodes)
        nodes.append(None)
        vantage, rest = members[0], np.array(members[1:], dtype=np.int64)
        children = []
        if len(rest):
            far = np.sqrt(_distances(centroids[rest], centroids[vantage]).astype(float))
            order = np.argsort(far, kind="stable")
            for half in np.array_split(order, 2):
                if len(half):
                    low, high = far[half[0]], far[half[-1]]
                    children.append((grow(rest[half].tolist()), float(low), float(high)))
        nodes[at] = Node(vantage, tuple(children))
        return at

    if len(centroids):
        grow(list(range(len(centroids))))
    return nodes


def nearest(
    vectors: np.ndarray, centroids: np.ndarray, tree: list[Node]
) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid and squared distance, and how many were measured."""
    count = len(vectors)
    rows = np.arange(count)
    cluster = np.full(count, len(centroids), dtype=np.int64)
    best = np.full(count, np.inf, dtype=centroids.dtype)
    radius = np.full(count, np.inf)
    bounds = np.full((count, len(tree)), np.inf)
    bounds[:, 0] = 0.0
    measured = 0
    while True:
        chosen = bounds[rows].argmin(axis=1)
        going = bounds[rows, chosen] <= radius[rows]  # inclusive: equals may have smaller numbers
        going &= np.isfinite(bounds[rows, chosen])
        rows, chosen = rows[going], chosen[going]
        if not len(rows):
            return cluster, best, measured
        for number in np.unique(chosen):
            node, here = tree[number], rows[chosen == number]
            measured += len(here)
            exact = _distances(vectors[here], centroids[node.centroid])
            better = (exact < best[here]) | (
                (exact == best[here]) & (node.centroid < cluster[here])
            )
            won = here[better]
            best[won], cluster[won] = exact[better], node.centroid
            far = np.sqrt(exact.astype(float))
            radius[won] = far[better] * (1 + SLACK)
            own = bounds[here, number]
            for child, low, high in node.children:
                bound = np.maximum(far - high, low - far) - SLACK * (far + high)
                bounds[here, child] = np.maximum(own, bound)
            bounds[here, number] = np.inf


def _exact(rows: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Integers in the type whose distances are exact, for all of the arrays together."""
    if all(not x.size or max(int(x.max()), -int(x.min())) <= EXACT for x in (rows, *others)):
        return rows.astype(np.float64)
    return rows.astype(object)


def _searched(batches, centroids: list[list[int]], tree: list[Node]):
    """(ids, vectors, cluster, distance) of slices of Arrow batches ``vec_id, v``."""
    points = np.array(centroids, dtype=object)
    size = max(1, TABLE // max(1, len(tree)))
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(batch.num_rows, -1)
        for at in range(0, batch.num_rows, size):
            part = vectors[at : at + size]
            mine = _exact(part, points)
            cluster, best, _ = nearest(mine, points.astype(mine.dtype), tree)
            yield batch.column(0).slice(at, size), mine, cluster, best


def kept_vectors(rows: DataFrame, dimensions: int, scale: int, column: str) -> DataFrame:
    """``vec_id`` and ``v``, the integer vector, of the rows whose vector can be used."""
    vector = F.col(column).cast("array<double>")
    usable = (F.size(vector) == dimensions) & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
    )
    # The test comes first in a struct of its own, so that null vectors do not reach floor.
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.transform(vector, lambda x: F.floor(x * float(scale)))).alias("v"),
    ).filter(F.col("v").isNotNull())


def first_centroids(vectors: DataFrame, count: int, seed: int) -> list[list[int]]:
    """The ``count`` vectors of smallest hash of their number; ties by the vector itself."""
    number = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), number), 256)
    rows = vectors.select(order.alias("hash"), "v").orderBy("hash", "v").limit(count)
    return [list(r["v"]) for r in rows.collect()]


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> list[Row]:
    """``cluster``, ``n`` and ``s0``, ``s1``, ... of every cluster that has vectors."""
    spark, dimensions = vectors.sparkSession, len(centroids[0])
    shared = spark.sparkContext.broadcast((centroids, build_tree(np.array(centroids, dtype=object))))

    def partial(batches):
        import pyarrow as pa

        points, tree = shared.value
        counts = [0] * len(points)
        sums = [[0] * dimensions for _ in points]
        for _, mine, cluster, _ in _searched(batches, points, tree):
            for k in np.unique(cluster).tolist():
                own = mine[cluster == k]
                counts[k] += len(own)
                # Floating point holds these sums: at most EXACT times TABLE.
                total = own.sum(axis=0)
                sums[k] = [a + int(b) for a, b in zip(sums[k], total, strict=True)]
        found = [k for k, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(found, pa.int32()),
                "n": pa.array([counts[k] for k in found], pa.int64()),
                "s": pa.array([[str(x) for x in sums[k]] for k in found], pa.list_(pa.string())),
            }
        )

    parts = vectors.mapInArrow(partial, "cluster int, n long, s array<string>")
    totals = [
        F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(dimensions)
    ]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect()


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast((centroids, build_tree(np.array(centroids, dtype=object))))

    def assigned(batches):
        import pyarrow as pa

        for ids, _, cluster, best in _searched(batches, *shared.value):
            distances = [min(int(x), GREATEST) for x in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(assigned, "vec_id long, cluster int, distance long")


def _long(total: Column) -> Column:
    return F.least(total, F.lit(GREATEST).cast("decimal(38,0)")).cast("long")


def cluster_vectors(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    column: str = "embedding",
) -> DataFrame:
    """A row for each usable vector: ``vec_id``, ``cluster``, ``distance`` (squared),
    ``cluster_inertia``, ``inertia`` and ``centroid`` (its final centroid's components).

    Vectors that are null, have other than ``dimensions`` components, or hold a null, NaN or
    infinity are left out. A component beyond 64 bits counts as the nearest 64-bit integer, and a
    distance or inertia beyond them is the greatest one. Equal distances go to the smaller
    number. A null vec_id is hashed as the empty string; rows with one vec_id are vectors of their
    own. With fewer vectors than ``clusters`` each is a centroid. Further columns are ignored; an
    empty table gives an empty result.
    """
    spark = rows.sparkSession
    vectors = stored(kept_vectors(rows, dimensions, scale, column), "cluster-vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        return _result(spark, _nothing(vectors), [])
    for _ in range(rounds):
        for total in _sums(vectors, centroids):
            centroids[total["cluster"]] = [
                int(total[f"s{k}"]) // total["n"] for k in range(dimensions)
            ]
    return _result(spark, stored(_assigned(vectors, centroids), "cluster-assigned"), centroids)


def _nothing(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))


def _result(spark: SparkSession, assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    totals = assigned.groupBy("cluster").agg(exact.alias("sum")).collect()
    whole = sum(int(r["sum"]) for r in totals)
    # One row for each centroid.
    table = spark.createDataFrame(
        [
            (r["cluster"], min(int(r["sum"]), GREATEST), min(whole, GREATEST), centroids[r["cluster"]])
            for r in totals
        ],
        T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid array<long>"),
    )
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
