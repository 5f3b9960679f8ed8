"""Personal data by bootstrapped contextual extraction (operator 13).

Seeds are the entities that fixed patterns find: e-mail and internet addresses, payment cards,
phones. Their surroundings are lexical patterns: the word before, the two words before, the word
before with the word behind (lower case, digits as 0, line ends as words). Other runs of words
with digits, and words with an at sign, are candidates with the same patterns. Patterns and the
different values they surround form a graph. Each of ``ROUNDS`` rounds scores

    pattern = sum of its values' scores / (its values + its other followers + 1),
    value   = 1 for a seed, else the best score of a pattern that is confident,

where other followers are all words of the corpus that stand in the pattern and are no candidate,
and a confident pattern has a score of ``CONFIDENT`` and ``SUPPORT`` summed up. So "the" is worth
nothing, however many addresses follow it, while "passport no." passes its confidence on to
values nobody has a rule for. Values of ``CONFIDENT`` are identifiers wherever they stand. Scores
are whole millionths: sums do not depend on their order.

The first pass writes entities and candidates, and skips the words of texts without a digit or an
at sign. The second counts other followers, if any pattern has ``SUPPORT`` values, and looks each
pattern up in a Bloom filter of these, of 16 bits a pattern and 2 ** ``BLOOM_BITS`` at most; what
it lets through by chance is dropped by the join with the patterns. Patterns that cannot become
confident leave the graph before the rounds. Counts combine in the tasks before each shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retailflow.llm import common
from retailflow.llm.common import row_number, stored

ROUNDS, SUPPORT, CONFIDENT = 3, 3, 0.5
#: Characters and digits of the shortest candidate.
SHORTEST, DIGITS = 5, 3
#: The largest filter has 2 ** BLOOM_BITS bits: 32 MB.
BLOOM_BITS = 28
#: Word hashes a worker keeps, characters it splits at a time, patterns it counts before it
#: passes them on.
CACHE, SLICE, COUNTED = 300_000, 1 << 20, 500_000

#: The kinds of spans, the base ones first; the last is what the method adds.
KINDS = ("email", "ip", "card", "phone", "identifier")
ADDED = len(KINDS) - 1
_ONE = 1_000_000

# The entities. A possessive part is the same match without backtracking.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ADDRESS = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9](?:[\x20().-]*+[0-9])++")

#: Line ends are words; a label keeps its sign, and what it labels is a word of its own.
_WORD = re.compile(r"\n|[^\s=:#]++[=:#]*+|[=:#]++")
_SOME = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_EDGES = "\"'`([{<>}]),.;:=#!?*|%$&"
_BREAK = 1  # the hash of a line end

_SPAN = "struct<start:bigint,kind:int,end:bigint>"
_CANDIDATE = "struct<start:bigint,kind:int,end:bigint,value:bigint,patterns:array<bigint>>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        number = int(digit) * (1 + k % 2)
        total += number - 9 * (number > 9)
    return total % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base entities, by start and kind."""
    found = []
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            after = domain.end()
            found.append((start, 0, after))
        at = text.find("@", at + 1)
    for m in _ADDRESS.finditer(text):
        parts = m[0].split(".") if m[1] else ()
        short = [p.lstrip("0") or "0" for p in parts]
        if parts and all(len(p) <= 3 and int(p) <= 255 for p in short):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


class WordHashes(dict):
    """The hash of each word in lower case, runs of digits as one 0."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if word == "\n":
            return _BREAK
        found = xxhash.xxh64_intdigest(re.sub("[0-9]+", "0", word.lower())) | 2
        if len(self) < CACHE:
            self[word] = found
        return found


def _slices(text: str) -> Iterator[tuple[int, str]]:
    """(place, part) of stretches of a text, cut before white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + SLICE)
        end = cut.start() if cut else len(text)
        yield start, text[start:end]
        start = end


_SPACE = re.compile(r"\s")


class Words:
    """A text's words by their hashes, with the patterns around any of them."""

    def __init__(self, text: str, hashes: WordHashes, placed: bool):
        found, starts, ends = [], [], []
        for at, part in _slices(text):
            if placed:
                places = [m.span() for m in _WORD.finditer(part)]
                part_words = [part[a:b] for a, b in places]
                starts.append(np.array([a for a, _ in places], dtype=np.int64) + at)
                ends.append(np.array([b for _, b in places], dtype=np.int64) + at)
            else:
                part_words = _WORD.findall(part)
            found.append(
                np.fromiter(map(hashes.__getitem__, part_words), np.uint64, len(part_words))
            )
        edge = np.array([_BREAK], dtype=np.uint64)
        #: With two line ends before and one behind.
        self.hashes = np.concatenate([edge, edge, *found, edge])
        self.count = len(self.hashes) - 3
        if placed:
            none = np.zeros(0, dtype=np.int64)
            self.starts = np.concatenate([none, *starts])
            self.ends = np.concatenate([none, *ends])

    def patterns(self, first, last):
        """The three patterns around stretches of words, a column each."""
        before = self.hashes[first + 1]
        # Nothing is read across a line end.
        two = np.where(before == _BREAK, np.uint64(_BREAK), self.hashes[first])
        behind = self.hashes[last + 3]
        factor = np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            keys = [
                before * factor + np.uint64(1),
                (two * factor + before) * factor + np.uint64(2),
                (before * factor + behind) * factor + np.uint64(3),
            ]
            mixed = [(k ^ (k >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) for k in keys]
        return np.stack([m ^ (m >> np.uint64(32)) for m in mixed], axis=1)


def _runs(text: str, words: Words) -> Iterator[tuple[int, int, int, int]]:
    """(first word, last word, start, end) of each candidate in a text without entities' words.

    Words with a digit that are one space apart are one candidate; its edges lose punctuation.
    """
    starts, ends = words.starts.tolist(), words.ends.tolist()
    k = 0
    while k < len(starts):
        word = text[starts[k] : ends[k]]
        if not _SOME.search(word):
            k += 1
            continue
        first = k
        if _DIGIT.search(word):
            while (
                k + 1 < len(starts)
                and starts[k + 1] == ends[k] + 1
                and text[ends[k]] == " "
                and _DIGIT.search(text, starts[k + 1], ends[k + 1])
            ):
                k += 1
        whole = text[starts[first] : ends[k]]
        core = whole.strip(_EDGES)
        digits = sum("0" <= c <= "9" for c in core)
        if len(core) >= SHORTEST and (digits >= DIGITS or "@" in core[1:-1]):
            start = starts[first] + whole.index(core)
            yield first, k, start, start + len(core)
        k += 1


class Text:
    """The entities and candidates of a text, and which of its words are neither."""

    def __init__(self, text: str, hashes: WordHashes):
        some = bool(_SOME.search(text))
        self.text = text
        self.words = Words(text, hashes, some)
        self.entities = entities(text) if some else []
        #: (first word, last word, start, kind, end)
        self.candidates = []
        plain = self.words.hashes[2:-1] != _BREAK
        if some:
            starts = self.words.starts
            for start, kind, end in self.entities:
                first, last = np.searchsorted(starts, [start, end - 1], side="right") - 1
                self.candidates.append((int(first), int(last), start, kind, end))
                plain[first : last + 1] = False
            taken = ~plain
            for first, last, start, end in _runs(text, self.words):
                if not taken[first : last + 1].any():
                    self.candidates.append((first, last, start, ADDED, end))
                    plain[first : last + 1] = False
        self.plain = np.flatnonzero(plain)

    def values(self) -> list[int]:
        """A hash of each candidate in lower case, without spaces and hyphens."""
        import xxhash

        cores = (self.text[start:end].lower() for _, _, start, _, end in self.candidates)
        return [xxhash.xxh64_intdigest(re.sub(r"[\s-]+", "", core)) for core in cores]

    def patterns(self):
        places = np.array([c[:2] for c in self.candidates], dtype=np.int64).reshape(-1, 2)
        return self.words.patterns(places[:, 0], places[:, 1])


def _signed(numbers) -> list[int]:
    return np.array(numbers, dtype=np.uint64).view(np.int64).tolist()


def _scan(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``base`` (entities) and ``candidates`` of every row."""

    def read(batches):
        hashes = WordHashes()
        for batch in batches:
            base, found = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                if not _SOME.search(text):
                    base.append([])
                    found.append([])
                    continue
                made = Text(text, hashes)
                base.append([dict(zip(("start", "kind", "end"), e, strict=True)) for e in made.entities])
                found.append(
                    [
                        {"start": c[2], "kind": c[3], "end": c[4], "value": v, "patterns": p}
                        for c, v, p in zip(
                            made.candidates,
                            _signed(made.values()),
                            made.patterns().view(np.int64).tolist(),
                            strict=True,
                        )
                    ]
                )
            long = pa.int64()
            span = [("start", long), ("kind", pa.int32()), ("end", long)]
            candidate = [*span, ("value", long), ("patterns", pa.list_(long))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(base, pa.list_(pa.struct(span))),
                    pa.array(found, pa.list_(pa.struct(candidate))),
                ],
                names=["doc_id", "base", "candidates"],
            )

    texts = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
    schema = f"doc_id bigint, base array<{_SPAN}>, candidates array<{_CANDIDATE}>"
    rows = texts.mapInArrow(read, schema)
    return stored(rows.withColumn("row", row_number()), "personal-scan")


def _others(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern`` and ``others``: how many words that are no candidate stand in it."""
    count = patterns.count()
    bits = min(BLOOM_BITS, max(16, (16 * count - 1).bit_length()))
    bitmap = common.bloom_filter(patterns.select("pattern"), bits)

    def read(batches):
        hashes, counts = WordHashes(), {}
        table = np.frombuffer(bitmap, dtype=np.uint8)

        def batch():
            made = pa.RecordBatch.from_pydict(
                {
                    "pattern": pa.array(_signed(list(counts)), pa.int64()),
                    "others": pa.array(list(counts.values()), pa.int64()),
                }
            )
            counts.clear()
            return made

        for texts in batches:
            for value in texts.column(0):
                made = Text(value.as_py() or "", hashes)
                for at in range(0, len(made.plain), SLICE):
                    places = made.plain[at : at + SLICE]
                    keys = made.words.patterns(places, places).reshape(-1)
                    keys = keys[common.bloom_hits(table, bits, keys)]
                    found, times = np.unique(keys, return_counts=True)
                    for key, n in zip(found.tolist(), times.tolist(), strict=True):
                        counts[key] = counts.get(key, 0) + n
                if len(counts) >= COUNTED:
                    yield batch()
        yield batch()

    texts = docs.selectExpr("CAST(text AS STRING) AS text")
    counted = texts.mapInArrow(read, "pattern bigint, others bigint")
    return counted.groupBy("pattern").agg(F.sum("others").alias("others"))


def _graph(docs: DataFrame, candidates: DataFrame, support: int, confident: int) -> DataFrame | None:
    """``pattern``, ``value``, ``seed``, ``size`` of the patterns that can become confident.

    ``size`` is what a pattern's summed score is divided by.
    """
    pairs = candidates.select("value", "kind", F.explode("patterns").alias("pattern"))
    edges = pairs.groupBy("pattern", "value").agg((F.min("kind") < ADDED).alias("seed"))
    edges = stored(edges, "personal-edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("held"))
    patterns = stored(sizes.filter(F.col("held") >= support), "personal-patterns")
    if patterns.isEmpty():
        return None
    others = stored(_others(docs, patterns), "personal-followers")
    size = F.col("held") + F.coalesce("others", F.lit(0)) + 1
    sized = (
        patterns.join(others, "pattern", "left")
        .select("pattern", size.alias("size"), "held")
        .filter(F.expr(f"{_ONE} * held div size") >= confident)
        .select("pattern", "size")
    )
    return stored(edges.join(stored(sized, "personal-sizes"), "pattern"), "personal-graph")


def _identifiers(graph: DataFrame, rounds: int, support: int, confident: int) -> DataFrame:
    """``value`` and ``score`` of the values that are no seeds and that patterns are confident of."""
    edges = graph.withColumn("score", F.when(F.col("seed"), _ONE).otherwise(0).cast("long"))
    total = F.sum("score")
    found = None
    for _ in range(rounds):
        scored = edges.groupBy("pattern").agg(total.alias("total"), F.first("size").alias("size"))
        sure = scored.select("pattern", "total", F.expr("total div size").alias("score")).filter(
            (F.col("score") >= confident) & (F.col("total") >= support * _ONE)
        )
        sure = stored(sure.select("pattern", "score"), "personal-confident")
        found = stored(
            graph.filter("NOT seed")
            .join(sure, "pattern")
            .groupBy("value")
            .agg(F.max("score").alias("score")),
            "personal-found",
        )
        edges = graph.join(found, "value", "left").withColumn(
            "score", F.when(F.col("seed"), _ONE).otherwise(F.coalesce("score", F.lit(0)))
        )
    return found


def find_personal_data(
    docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_<kind>`` of every kind and ``spans`` (start,
    kind, end, score of each, by start and kind). Places are code points, ends exclusive; the
    score is 1 for entities, else that of the best pattern around the value.

    Null and empty texts hold nothing. Rows are rows of their own whatever their doc_id; a
    repeated text's values count once for each pattern, its other words each time. Further columns
    are ignored; an empty table gives an empty result.
    """
    scanned = _scan(docs)
    threshold = round(confident * _ONE)
    exploded = scanned.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    graph = _graph(docs, exploded, support, threshold)
    base = F.transform(
        "base",
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                           F.lit(1.0).alias("score")),
    )
    rows = scanned.select("row", "doc_id", base.alias("base"))
    kind = "array<struct<start:bigint,kind:int,end:bigint,score:double>>"
    if graph is None:
        rows = rows.withColumn("added", F.array().cast(kind))
    else:
        found = _identifiers(graph, rounds, support, threshold)
        span = F.struct("start", "kind", "end", (F.col("score") / _ONE).alias("score"))
        places = (
            exploded.filter(F.col("kind") == ADDED)
            .join(found, "value")
            .groupBy("row")
            .agg(F.collect_list(span).alias("added"))
        )
        rows = rows.join(places, "row", "left").withColumn(
            "added", F.coalesce("added", F.array().cast(kind))
        )
    rows = rows.select("doc_id", F.sort_array(F.concat("base", "added")).alias("spans"))

    def count(number: int, name: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == number)
        return F.size(own).cast("long").alias(f"n_{name}")

    return rows.select("doc_id", *[count(k, name) for k, name in enumerate(KINDS)], "spans")


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    numbers = [KINDS.index(k) for k in kinds]
    parts = F.transform(
        F.filter(spans, lambda s: s["kind"].isin(numbers)),
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")
