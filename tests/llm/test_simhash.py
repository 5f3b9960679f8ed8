"""SimHash near-duplicates against all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from retailflow.llm import simhash


def brute_print(text, shingle=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance):
    """Class number of each print, by links between all pairs."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    return [find(k) for k in range(len(prints))]


def wanted_rows(rows):
    prints = [brute_print(t) for _, t in rows]
    classes = brute_classes(prints, 2)
    least = {}
    for (doc_id, _), c in zip(rows, classes, strict=True):
        if doc_id is not None:
            least[c] = min(doc_id, least.get(c, doc_id))
    return sorted(
        str((doc_id, f"{p:016x}", least.get(c)))
        for (doc_id, _), p, c in zip(rows, prints, classes, strict=True)
    )


def test_messy_rows(messy, messy_rows):
    found = simhash.near_duplicates(messy).collect()
    assert sorted(str(tuple(r)) for r in found) == wanted_rows([(r[0], r[1]) for r in messy_rows])


def test_query_against_all_pairs(spark, small_documents):
    import __spark_entry__

    found = __spark_entry__.queries()["op5_simhash"](spark, "/root/testdata/sf0.001").collect()
    rows = [(d["doc_id"], d["text"]) for d in small_documents]
    assert sorted(str(tuple(r)) for r in found) == wanted_rows(rows)


def test_spark_hashes_alike(spark):
    (row,) = spark.sql("SELECT xxhash64('one two three') AS h").collect()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"one two three", seed=42)


@pytest.mark.parametrize(("distance", "pairs"), [(2, 128), (2, 1), (1, 1), (0, 1), (3, 2), (3, 128)])
def test_links_join_what_is_near(spark, distance, pairs):
    rng = random.Random(distance)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            prints.add(base ^ flips)
    prints = sorted(prints)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    edges = simhash.links(frame, distance, pairs).collect()
    for a, b in edges:
        assert ((a ^ b) % 2**64).bit_count() <= distance and a != b
    found = {r["node"]: r["root"] for r in simhash.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    classes = brute_classes(prints, distance)
    by_class = {}
    for p, c in zip(prints, classes, strict=True):
        by_class.setdefault(c, []).append(simhash._signed(p))
    for members in by_class.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_components_of_a_long_path(spark):
    nodes = list(range(200))
    random.Random(1).shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")
    roots = simhash.components(edges).collect()
    assert sorted(map(tuple, roots)) == [(k, 0) for k in range(200)]


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_one_of_each_component_stays(messy, messy_rows):
    kept = simhash.drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    classes = brute_classes([brute_print(r[1]) for r in messy_rows], 2)
    assert kept.count() == len(set(classes))
    ids = simhash.near_duplicates(messy).select("component_id").distinct()
    named = kept.select("doc_id").filter("doc_id IS NOT NULL")
    assert named.subtract(ids).count() == 0
    assert kept.filter(F.col("row") != "r").count() == 0
