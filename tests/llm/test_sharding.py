"""Sharding: the law of equal rows, and the mixture in every shard."""

import zlib
from collections import Counter, defaultdict

import pytest

from retailflow.llm import sharding


def check(found, texts, shards):
    assert Counter(map(str, (r["doc_id"] for r in found))) == Counter(str(i) for i, _ in texts)
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[k] for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    numbers = Counter(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == numbers


def test_messy_rows(messy, messy_rows):
    for shards in (1, 4, 40):
        check(sharding.interleave(messy, shards).collect(), [r[:2] for r in messy_rows], shards)


def test_every_stretch_has_the_mixture(spark):
    rows = [(k, f"t{k}", "hot" if k % 3 else f"s{k % 7}", ) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sharding.interleave(docs, 10).collect()
    total = Counter(r["source"] for r in found)
    by_shard = defaultdict(Counter)
    for r in found:
        by_shard[r["shard"]][r["source"]] += 1
    for shard in by_shard.values():
        for source, n in total.items():
            assert abs(shard[source] - n / 10) <= 3  # sources of one size rank alike


def test_the_seed_shuffles(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "'x' AS text", "'a' AS source")
    order = [
        [r["doc_id"] for r in sharding.interleave(docs, 5, seed).orderBy("shard", "slot").collect()]
        for seed in (1, 1, 2)
    ]
    assert order[0] == order[1] != order[2]


@pytest.mark.parametrize("shards, seed", [(7, 42), (40, 3)])
def test_order_by_brute_force(spark, shards, seed):
    """Fractional ranks, their order and the cuts, computed one by one."""
    rows = [(k, f"t{k % 50}", (None, "hot", "hot", f"s{k % 9}")[k % 4]) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    columns = "doc_id", "source", "crc32(CAST(text AS BINARY)) AS c", "CAST(length(text) + 16 AS BIGINT) AS s"
    hashed = docs.selectExpr(*columns).selectExpr(
        "doc_id", "source", f"xxhash64({seed}, doc_id, c, s) AS shuffled"
    )
    by_source = defaultdict(list)
    for r in hashed.collect():
        by_source[r["source"] or ""].append((r["shuffled"], r["doc_id"]))
    placed = []
    for source, members in by_source.items():
        for k, (shuffled, doc_id) in enumerate(sorted(members)):
            placed.append(((k + 0.5) / len(members), source, shuffled, doc_id))
    total, wanted, starts = len(placed), {}, {}
    for n, (*_, doc_id) in enumerate(sorted(placed)):
        shard = n * shards // total
        wanted[doc_id] = (shard, n - starts.setdefault(shard, n))
    found = sharding.interleave(docs, shards, seed).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in found} == wanted


def test_empty_table(nothing):
    assert sharding.interleave(nothing).count() == 0


@pytest.mark.parametrize("shards", [40])
def test_query(spark, llm_tables, shards):
    import __spark_entry__

    docs = spark.read.parquet(f"{llm_tables}/documents.parquet").select("doc_id", "text").collect()
    found = __spark_entry__.queries()["op7_sharding"](spark, llm_tables).collect()
    check(found, [tuple(d) for d in docs], shards)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
