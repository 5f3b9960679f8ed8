"""SimHash near-duplicates by pigeonring filtering (operator 5).

Fingerprints of 64 bits are cut into d + 1 segments in a ring, d being the greatest distance.
If two fingerprints differ in at most d bits, some segment starts a chain of consecutive
segments whose first l members together differ in at most l * d / (d + 1) bits, for every l:
none in the first segment, at most one in the first two. So the first segment and one half of
the second are equal; that is the join key (``2 (d + 1)`` of them). The other budgets of the
chain are checked before the full distance.

Only different fingerprints are joined, copies having been grouped before. A key shared by more
than ``PAIRS`` fingerprints is not joined with itself: each of its members is written under
every choice of d bits outside the key blanked out. Two members agree under some choice just
when they differ in at most d bits, and at most 2 ** d fingerprints agree under one choice, so
that path grows with the members and finds the same links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from retailflow.llm.common import checkpointed, row_number, stored

SHINGLE, DISTANCE = 3, 2
BITS = 64
PAIRS = 128


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 if it has no words."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(part, 42) for part in parts], dtype="<u8")
    half = len(hashes) // 2
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 15):
        bits = hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts > half, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint_of(t.as_py(), shingle) for t in texts], pa.int64())

    return made(text.cast("string"))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments of the ring."""
    count = distance + 1
    at = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(at)]


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _key_masks(distance: int) -> list[int]:
    """The bits of each join key: a segment and one half of the next."""
    segments = _segments(distance)
    masks = []
    for k, (first, width) in enumerate(segments):
        if distance == 0:
            return [_mask(first, width)]
        next_first, next_width = segments[(k + 1) % len(segments)]
        half = next_width // 2
        for part in ((next_first, half), (next_first + half, next_width - half)):
            masks.append(_mask(first, width) | _mask(*part))
    return masks


def _within(a: Column, b: Column, kind: Column, distance: int) -> Column:
    """Whether the chain that starts at the key's segment keeps all its budgets."""
    segments = _segments(distance)
    differing = a.bitwiseXOR(b)
    chains = F.lit(False)
    for start in range(len(segments)):
        reached, kept = 0, F.lit(True)
        for length in range(1, len(segments) + 1):
            reached |= _mask(*segments[(start + length - 1) % len(segments)])
            budget = length * distance // len(segments)
            kept &= F.bit_count(differing.bitwiseAND(F.lit(_signed(reached)))) <= budget
        chains |= (F.floor(kind / 2) == start) & kept
    return chains


def links(fingerprints: DataFrame, distance: int = DISTANCE, pairs: int = PAIRS) -> DataFrame:
    """Links ``a``, ``b`` that join all of the distinct ``fp`` within the distance.

    Every pair within the distance is connected by links, and every link is such a pair.
    """
    masks = _key_masks(distance)
    keys = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for k, m in enumerate(masks)
        ]
    )
    rows = fingerprints.select("fp", F.explode(keys).alias("k")).select("fp", "k.*")
    sizes = rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, so that the join splits a hot key.
    sizes = stored(sizes, "simhash-sizes")
    crowded = stored(rows.join(sizes, ["kind", "key"]), "simhash-keys")
    few = crowded.filter(F.col("n") <= pairs)
    left = few.select("kind", "key", F.col("fp").alias("a"))
    right = few.select("kind", "key", F.col("fp").alias("b"))
    near = left.join(right, ["kind", "key"]).filter(
        (F.col("a") < F.col("b"))
        & _within(F.col("a"), F.col("b"), F.col("kind"), distance)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    return near.select("a", "b").union(_blanked(crowded.filter(F.col("n") > pairs), distance))


def _blanked(rows: DataFrame, distance: int) -> DataFrame:
    """Links among the members of large keys, by blanking out every choice of bits."""
    blanks = []
    for kind, mask in enumerate(_key_masks(distance)):
        free = [1 << k for k in range(BITS) if not mask >> k & 1]
        choices = itertools.combinations(free, min(distance, len(free)))
        blanks += [(kind, _signed(sum(c))) for c in choices] if distance else []
    # A fixed table: its size follows from the distance alone.
    table = rows.sparkSession.createDataFrame(blanks, "kind int, blank long")
    rest = F.col("fp").bitwiseAND(F.bitwise_not("blank")).alias("rest")
    same = Window.partitionBy("kind", "blank", "rest")
    return (
        rows.join(F.broadcast(table), "kind")
        .select("kind", "blank", rest, "fp")
        .withColumn("a", F.min("fp").over(same))
        .filter(F.col("a") < F.col("fp"))
        .select("a", F.col("fp").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is linked with, for every node of an edge.

    Alternates large stars (every greater neighbour to the least one) and small stars (every
    smaller neighbour to the least one), until nothing changes. Each round is two
    aggregations and two joins over at most as many edges as before, written to the shared
    folder; the driver sees two numbers a round.
    """

    def state(rows):
        found = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")))
        return tuple(found.collect()[0])

    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "components")
    before = state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "components")
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(edges.select("a", "a").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star-centres")
    joined = both.filter("v > u").join(least, "u")
    return joined.select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """From edges with a < b or a = b to edges (least, other)."""
    edges = edges.filter("a < b").distinct()
    least = stored(edges.groupBy("b").agg(F.min("a").alias("m")), "star-centres")
    joined = edges.join(least, "b")
    moved = joined.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp`` and ``component_id``, the least ``doc_id`` linked with it, for all of ``prints``.

    ``prints`` has ``doc_id`` and ``fp``; a component without any doc_id has a null id.
    """
    distinct = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-fingerprints"
    )
    roots = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least = stored(least, "simhash-components")
    return rooted.join(least, "root").select("fp", "component_id", "root")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Null, empty and blank texts have the fingerprint zero and are linked like any other. A
    null ``doc_id`` keeps its row and never names a component unless all in it are null;
    repeated rows are copies. Further columns are ignored; an empty table gives none.
    """
    prints = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            fingerprint(F.col("text"), shingle).alias("fp"),
        ),
        "simhash-rows",
    )
    found = classes(prints, distance).drop("root")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(found, "fp").select("doc_id", digits, "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id, nulls last, then the first row."""
    rows = checkpointed(
        docs.select(
            row_number().alias("row"),
            F.struct("*").alias("doc"),
            fingerprint(F.col("text"), shingle).alias("fp"),
        )
    )
    doc_id = F.col("doc.doc_id").cast("long").alias("doc_id")
    prints = stored(rows.select("row", doc_id, "fp"), "simhash-rows")
    rooted = classes(prints, distance).select("fp", "root")
    # The order of a struct puts nulls first, so the test comes before the number.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = prints.groupBy("fp").agg(F.min(order).alias("first")).join(rooted, "fp")
    kept = least.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    return rows.select("row", "doc").join(kept, "row", "left_semi").select("doc.*")
