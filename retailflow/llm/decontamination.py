"""Benchmark decontamination by greedy string tiling (operator 2).

Texts are sequences of words in lower case, as 64-bit hashes. A document and a test item are
compared if they share a seed, ``MATCH`` words in a row. For such a pair, tiling repeatedly marks
the longest matches that overlap no marked word of either side, found by running Karp-Rabin
hashes at falling lengths; the item's share of marked words is its coverage. Tiles may stand in
any order, so a passage with its sentences reordered is covered like the original. One tile of
``LONG`` words is an excerpt and condemns a document too, however long the item is. An item of
fewer than ``MATCH`` words is one seed, and so is a document of so few: such an item condemns the
documents that consist of its words, in its order, and nothing longer.

A seed that many items share, such as the words a question begins with, would be joined with
every document that holds it. So each item leaves out its costliest seeds, by documents times
items, as many as could not condemn a document alone: their windows cover too few of its words
and no ``LONG`` of them in a row. Whatever it condemns has one of its other seeds, and so many of
them as are needed to make up the rest. A seed of one item is never left out. That is exact, and
pairs are listed only for telling seeds.

The documents are read once. Their seeds pass a Bloom filter of the items' seeds, of 16 bits a
seed and 2 ** ``BLOOM_BITS`` at most; what it lets through by chance is dropped by the join with
the seeds. So few words of clean documents are shuffled, and no text. A row of
the tiling holds the passing stretches of one document and one item.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retailflow.llm.common import (
    bloom_filter,
    bloom_hits,
    checkpointed,
    row_number,
    stored,
)

#: Words of a seed and of the shortest tile; share of an item's words that condemns a document,
#: and words of a single tile that do.
MATCH, COVERAGE, LONG = 5, 0.6, 30
#: The largest Bloom filter has 2 ** BLOOM_BITS bits: 32 MB.
BLOOM_BITS = 28
#: Words whose hashes a worker keeps, and characters it works on at a time.
CACHE, SLICE = 300_000, 1 << 20

_FACTOR = 0x9E3779B97F4A7C15
#: Stands between stretches of a document; equal to no word's hash.
GAP = 0


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        found = xxhash.xxh64_intdigest(word) or 1
        if len(self) < CACHE:
            self[word] = found
        return found


def word_finder():
    import re

    return re.compile(r"\w+").findall


def rolling(words, length: int):
    """The Karp-Rabin hash of every ``length`` words in a row (64-bit, wrapping)."""
    import numpy as np

    if len(words) < length:
        return np.zeros(0, dtype=np.uint64)
    count = len(words) - length + 1
    total = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            total = total * np.uint64(_FACTOR) + words[k : k + count]
        return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def seed_hashes(words, match: int):
    """The hash of every ``match`` words in a row; of fewer words, one hash of them all."""
    return rolling(words, min(match, max(1, len(words))))


def reach(windows, match: int) -> tuple[int, int]:
    """How many words the marked windows of ``match`` words cover, and how many in one row of
    windows, which is the longest tile they allow."""
    import numpy as np

    if not windows.any():
        return 0, 0
    covered = np.convolve(windows, np.ones(match, dtype=np.int64)) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], windows, [0]))))
    return int(covered.sum()), int((edges[1::2] - edges[::2]).max()) + match - 1


def may_condemn(windows, match: int, coverage: float, long: int) -> bool:
    """Whether tiles inside the marked windows of an item could condemn a document."""
    covered, longest = reach(windows, match)
    return covered >= coverage * (len(windows) + match - 1) - 1e-9 or longest >= long


def left_out(words, costly, match: int, coverage: float, long: int) -> tuple[int, int]:
    """How many of the ``costly`` seeds of an item, the costliest first, are left out, and how
    many seeds, counting repeats, a condemned document shares of the others at least."""
    import math

    import numpy as np

    windows = seed_hashes(words, match)
    match = min(match, len(words))
    low, high = 0, len(costly)
    while low < high:  # more seeds never condemn less
        middle = (low + high + 1) // 2
        if may_condemn(np.isin(windows, costly[:middle]), match, coverage, long):
            high = middle - 1
        else:
            low = middle
    gone = np.isin(windows, costly[:low])
    rest = coverage * len(words) - reach(gone, match)[0]
    need = min(math.ceil(rest / match - 1e-9), long - match + 1 - int(gone.sum()))
    return low, max(1, need)


def _maximal(left, right, shortest: int) -> list[tuple[int, int, int]]:
    """(-length, place in left, place in right) of every match of ``shortest`` words or more
    that no equal words before or behind would make longer.

    A word of the right side is compared with all places of the left that have its window's
    hash. Places that go on a match are left out, so a word repeated on both sides is as many
    matches as the sides have words, not as many as their product.
    """
    import numpy as np

    one, two = rolling(left, shortest), rolling(right, shortest)
    order = np.argsort(one, kind="stable")
    ranked = one[order]
    first = np.searchsorted(ranked, two, side="left")
    behind = np.searchsorted(ranked, two, side="right")
    places, others = [], []
    for other in np.flatnonzero(behind > first).tolist():
        own = order[first[other] : behind[other]]
        if other:
            before = np.where(own > 0, left[own - 1] == right[other - 1], False)
            own = own[~before]
        places.append(own)
        others.append(np.full(len(own), other))
    if not places:
        return []
    place, other = np.concatenate(places), np.concatenate(others)
    length = np.full(len(place), shortest)
    going = np.arange(len(place))
    while len(going):
        a, b = place[going] + length[going], other[going] + length[going]
        inside = (a < len(left)) & (b < len(right))
        going, a, b = going[inside], a[inside], b[inside]
        going = going[left[a] == right[b]]
        length[going] += 1
    # A window's hash may agree by chance.
    good = [
        np.array_equal(left[a : a + shortest], right[b : b + shortest])
        for a, b in zip(place, other, strict=True)
    ]
    rows = zip((-length).tolist(), place.tolist(), other.tolist(), good, strict=True)
    return [(n, a, b) for n, a, b, same in rows if same]


def tiles(left, right, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in left, place in right, length) of the marked matches.

    The longest match is marked, then the longest that overlaps no marked word, and so on;
    ties by place. What marked words leave of a match waits as matches of its own.
    """
    import numpy as np

    free = [np.ones(len(left), dtype=bool), np.ones(len(right), dtype=bool)]
    waiting = _maximal(left, right, shortest)
    heapq.heapify(waiting)
    marked = []
    while waiting:
        length, place, other = heapq.heappop(waiting)
        length = -length
        open_ = free[0][place : place + length] & free[1][other : other + length]
        if open_.all():
            free[0][place : place + length] = False
            free[1][other : other + length] = False
            marked.append((place, other, length))
            continue
        if open_.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([False], open_, [False]))))
            for start, end in edges.reshape(-1, 2).tolist():
                if end - start >= shortest:
                    heapq.heappush(waiting, (start - end, place + start, other + start))
    return sorted(marked)


def _items(benchmark: DataFrame, match: int) -> tuple[DataFrame, DataFrame]:
    """The items with their words' hashes, and a row for each of their seeds."""

    def read(batches):
        hashes, find = WordHashes(), word_finder()
        import numpy as np

        for batch in batches:
            words, seeds, times = [], [], []
            for text in batch.column(2):
                found = find((text.as_py() or "").lower())
                words.append(np.array([hashes[w] for w in found], dtype=np.uint64).view(np.int64))
                seed, count = np.unique(
                    seed_hashes(words[-1].view(np.uint64), match), return_counts=True
                )
                times.append(count)
                seeds.append(seed.view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (words, seeds, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists],
                names=["item", "item_id", "words", "seeds", "times"],
            )

    rows = benchmark.select(
        row_number().alias("item"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("text").cast("string").alias("text"),
    )
    types = "item long, item_id string, words array<long>, seeds array<long>, times array<long>"
    items = stored(rows.mapInArrow(read, types), "benchmark-items")
    zipped = F.explode(F.arrays_zip("seeds", "times")).alias("s")
    seeds = items.select("item", zipped).select("item", F.col("s.seeds").alias("seed"), "s.times")
    return items, seeds


def _stretches(rows: DataFrame, bloom: bytes, match: int, bits: int) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, and of the words around passing seeds the hashes
    (``words``, a gap between stretches), their places in the text and the seeds."""

    def read(batches):
        import numpy as np

        hashes, find = WordHashes(), word_finder()
        bitmap = np.frombuffer(bloom, dtype=np.uint8)

        def slices(texts):
            part, size = [], 0
            for text in texts:
                part.append(find((text.as_py() or "").lower()))
                size += len(part[-1])
                if size * 6 >= SLICE:
                    yield part
                    part, size = [], 0
            yield part

        for batch in batches:
            counts, words, places, seeds = [], [], [], []
            for part in slices(batch.column(2)):
                sizes = np.array([len(found) for found in part], dtype=np.int64)
                every = np.fromiter(
                    (hashes[w] for found in part for w in found), np.uint64, sizes.sum()
                )
                firsts = np.concatenate(([0], np.cumsum(sizes)))
                rolled = rolling(every, match)
                hits = bloom_hits(bitmap, bits, rolled)
                owner = np.searchsorted(firsts, hits, side="right") - 1
                inside = hits + match <= firsts[owner + 1]  # not across two texts
                hits, owner = hits[inside], owner[inside]
                bounds = np.searchsorted(owner, np.arange(len(part) + 1))
                short = np.flatnonzero((sizes > 0) & (sizes < match))
                wholes = [seed_hashes(every[firsts[k] : firsts[k + 1]], match)[0] for k in short]
                wholes = np.array(wholes, dtype=np.uint64)
                passed = bloom_hits(bitmap, bits, wholes)
                whole = dict(zip(short[passed].tolist(), wholes[passed], strict=True))
                for k in range(len(part)):
                    own = hits[bounds[k] : bounds[k + 1]]
                    counts.append(int(sizes[k]))
                    if k in whole:
                        words.append(every[firsts[k] : firsts[k + 1]].view(np.int64))
                        places.append(np.arange(sizes[k]))
                        seeds.append(np.array([whole[k]], dtype=np.uint64).view(np.int64))
                        continue
                    if not len(own):
                        words.append([])
                        places.append([])
                        seeds.append([])
                        continue
                    covered = np.unique((own[:, None] + np.arange(match)).ravel())
                    breaks = np.flatnonzero(np.diff(covered) > 1) + 1
                    words.append(np.insert(every[covered], breaks, GAP).view(np.int64))
                    places.append(np.insert(covered - firsts[k], breaks, -1))
                    seeds.append(np.unique(rolled[own]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(words, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "n_words", "words", "places", "seeds"],
            )

    lists = ", ".join(f"{c} array<long>" for c in ("words", "places", "seeds"))
    types = f"row long, doc_id long, n_words long, {lists}"
    return rows.select("row", "doc_id", "text").mapInArrow(read, types)


def _tiled(
    words: pa.Array, places: pa.Array, item: pa.Array, match: pa.Array, coverage: pa.Array,
    long: pa.Array,
) -> pa.Array:
    """Of each pair the item's words in tiles, and the tiles' places in the text; nothing where
    the shared windows cannot condemn."""
    import numpy as np

    found = []
    for w, p, i, m, c, n in zip(words, places, item, match, coverage, long, strict=True):
        left, right = (np.array(x.as_py(), dtype=np.int64).view(np.uint64) for x in (w, i))
        at, least, marked = p.as_py(), min(m.as_py(), len(right)), []
        shared = np.isin(rolling(right, least), rolling(left, least))
        if may_condemn(shared, least, c.as_py(), n.as_py()):
            marked = tiles(left, right, least)
        spans = [{"start": at[a], "end": at[a] + n} for a, _, n in marked]
        found.append({"covered": sum(n for _, _, n in marked), "spans": spans})
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.array(found, pa.struct([("covered", pa.int64()), ("spans", pa.list_(span))]))


def _telling(
    items: DataFrame, item_seeds: DataFrame, seeds: DataFrame, match: int, coverage: float, long: int
) -> DataFrame:
    """``item``, ``need``, ``seed``, ``times`` of the seeds that items do not leave out."""

    def choose(words: pa.Array, costly: pa.Array) -> pa.Array:
        import numpy as np

        found = []
        for w, c in zip(words, costly, strict=True):
            own, most = (np.array(x.as_py(), dtype=np.int64).view(np.uint64) for x in (w, c))
            gone, need = left_out(own, most, match, coverage, long) if len(own) else (0, 1)
            found.append({"gone": most[:gone].view(np.int64).tolist(), "need": need})
        return pa.array(found, pa.struct([("gone", pa.list_(pa.int64())), ("need", pa.int64())]))

    # Both counts combine in the tasks; stored, so that the join splits a seed of many items.
    shared = item_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("items")).filter("items > 1")
    held = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("docs"))
    costs = shared.join(held, "seed").select("seed", (F.col("docs") * F.col("items")).alias("cost"))
    costs = stored(costs, "seed-costs")
    # One list for each item, of its own seeds: no longer than its text.
    costly = (
        item_seeds.join(costs, "seed")
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("cost", "seed")), asc=False).alias("costly"))
    )
    none = F.array().cast("array<bigint>")
    chosen = (
        items.join(costly, "item", "left")
        .withColumn("costly", F.coalesce("costly.seed", none))
        .withColumn("c", F.arrow_udf(choose, "struct<gone:array<long>,need:long>")("words", "costly"))
    )
    kept = F.filter(
        F.arrays_zip("seeds", "times"), lambda s: ~F.array_contains("c.gone", s["seeds"])
    )
    chosen = stored(chosen.select("item", F.col("c.need").alias("need"), kept.alias("kept")), "telling")
    return chosen.select("item", "need", F.explode("kept").alias("s")).select(
        "item", "need", F.col("s.seeds").alias("seed"), "s.times"
    )


def candidates(
    items: DataFrame, item_seeds: DataFrame, stretches: DataFrame, match: int, coverage: float,
    long: int,
) -> DataFrame:
    """``row`` and ``item`` of the pairs that share enough telling seeds."""
    seeds = stretches.select("row", F.explode("seeds").alias("seed"))
    telling = _telling(items, item_seeds, seeds, match, coverage, long)
    return (
        seeds.join(telling, "seed")
        .groupBy("row", "item", "need")
        .agg(F.sum("times").alias("shared"))
        .filter(F.col("shared") >= F.col("need"))
        .select("row", "item")
    )


def _verdicts(
    rows: DataFrame, benchmark: DataFrame, match: int, coverage: float, long: int, bits: int | None
) -> tuple[DataFrame, DataFrame]:
    """The documents' stretches, and their pairs with items that condemn them."""
    items, item_seeds = _items(benchmark, match)
    if bits is None:
        bits = min(BLOOM_BITS, max(16, (16 * item_seeds.count()).bit_length()))
    bloom = bloom_filter(item_seeds.select("seed"), bits)
    stretches = stored(_stretches(rows, bloom, match, bits), "stretches")
    # Stored, so that their size is known before the stretches are moved: few are broadcast.
    pairs = stored(candidates(items, item_seeds, stretches, match, coverage, long), "pairs")
    tiling = F.arrow_udf(_tiled, "struct<covered:long,spans:array<struct<start:long,end:long>>>")
    limits = [F.lit(match), F.lit(float(coverage)), F.lit(long)]
    tiled = (
        pairs.join(stretches.filter("size(words) > 0").select("row", "words", "places"), "row")
        .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
        .withColumn("found", tiling("words", "places", "item_words", *limits))
        .select(
            "row",
            "item_id",
            (F.col("found.covered") / F.size("item_words")).alias("coverage"),
            "found.spans",
        )
        .filter(
            (F.col("coverage") >= coverage)
            | F.exists("spans", lambda s: s["end"] - s["start"] >= long)
        )
    )
    return stretches, tiled


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    match: int = MATCH,
    coverage: float = COVERAGE,
    long: int = LONG,
    bits: int | None = None,
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_words``, ``n_items`` (test items with enough
    coverage or a long tile), ``item_id`` and ``coverage`` of the one covered most (ties: the least id),
    ``spans`` (start:end of its tiles in words, comma-joined) and ``contaminated``.

    Null texts have no words, and an item without words condemns nothing. An item of fewer than
    ``match`` words condemns the documents that are its words and no more. Null and repeated ids
    are rows of their own; repeated items count each. Further columns are ignored. Without
    documents the result is empty; without items nothing is contaminated.
    """
    rows = docs.select(
        row_number().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    # The rows are numbered in the one scan that writes the stretches.
    stretches, tiled = _verdicts(rows, benchmark, match, coverage, long, bits)
    best = F.struct((-F.col("coverage")).alias("c"), "item_id", "spans")
    span = F.transform("best.spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    worst = tiled.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.min(best).alias("best"))
    return (
        stretches.select("row", "doc_id", "n_words")
        .join(worst, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.col("best.item_id").alias("item_id"),
            F.coalesce(-F.col("best.c"), F.lit(0.0)).alias("coverage"),
            F.coalesce(F.array_join(span, ","), F.lit("")).alias("spans"),
            F.col("n_items").isNotNull().alias("contaminated"),
        )
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    match: int = MATCH,
    coverage: float = COVERAGE,
    long: int = LONG,
    bits: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` that no test item condemns, with all their columns."""
    rows = checkpointed(docs.select(row_number().alias("row"), F.struct("*").alias("doc")))
    texts = rows.select(
        "row",
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        F.col("doc.text").cast("string").alias("text"),
    )
    _, tiled = _verdicts(texts, benchmark, match, coverage, long, bits)
    return rows.join(tiled.select("row").distinct(), "row", "left_anti").select("doc.*")
