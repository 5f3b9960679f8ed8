"""Secret scans by corpus-wide ownership frequency (operator 10).

The candidates of a text are found by fixed patterns. Each value's hash is counted over the whole
corpus by different repositories and owners: a value that ``WIDE`` owners or more hold is a widely
copied example, one that fewer hold is owner-specific and looks live. Long tokens of mixed
characters are candidates too, and become secrets only if fewer than ``WIDE`` owners hold them.

One scan writes, for the texts with a candidate, the lengths between matches and the values'
hashes; places are running sums of these lengths. The counts combine in the tasks before the
shuffle, by (value, owner) before (value). Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from retailflow.llm.common import row_number, stored

#: Owners from which on a value is a widely copied example.
WIDE = 3

# Each kind with its pattern, the group of the value, the value's least length, and
# what else it must hold.
KINDS = {
    "assign": (
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        6,
        (),
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, ()),
    "hex": (r"[0-9a-f]{24,}", 0, 24, ()),
    "mixed": (r"[A-Za-z0-9+/_-]{32,}", 0, 32, ("[0-9]", "[a-z]", "[A-Z]")),
}
#: Kinds that are secrets only if fewer than ``WIDE`` owners hold them; the others are the base.
ADDED = ("mixed",)

# A text without any of these holds no candidate.
_ANY = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}"
    r"|[0-9a-f]{24}|[A-Za-z0-9+/_-]{32}"
)

_SPAN = "struct<start:bigint,kind:int,end:bigint,owners:bigint,repositories:bigint>"


def _matches(text: Column, pattern: str, group: int, least: int, holds: tuple) -> Column:
    """(length before the match since the last one, its length, the value's hash, whether it
    counts) of each match: also those that don't count move the places."""

    def counts(value: Column) -> Column:
        good = F.length(value) >= least
        for part in holds:
            good &= value.rlike(part)
        return good

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value")
    )
    return F.transform(
        F.filter(zipped, lambda m: m["whole"].isNotNull()),
        lambda m: F.struct(
            F.length(m["gap"]).alias("gap"),
            F.length(m["whole"]).alias("length"),
            F.xxhash64(m["value"]).alias("hash"),
            counts(m["value"]).alias("counts"),
        ),
    )


def _scan(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = text.rlike(_ANY)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.inline(F.array(F.struct(F.when(some, text).alias("text")))),
    )
    found = [
        F.when(F.col("text").isNotNull(), _matches(F.col("text"), *rule)).alias(kind)
        for kind, rule in KINDS.items()
    ]
    return stored(
        rows.select(row_number().alias("row"), "doc_id", "owner", "repository", *found),
        "secret-scan",
    )


def _candidates(scanned: DataFrame) -> DataFrame:
    """A row for each candidate: its row, owner, repository, kind, start, end and hash."""
    frames = []
    for number, kind in enumerate(KINDS):
        matches = scanned.select(
            "row", "owner", "repository", F.posexplode(kind).alias("k", "m")
        ).select("row", "owner", "repository", "k", "m.*")
        frames.append(matches.withColumn("kind", F.lit(number)))
    every = frames[0]
    for frame in frames[1:]:
        every = every.union(frame)
    # A partition is one text's matches of one kind.
    so_far = Window.partitionBy("row", "kind").orderBy("k")
    end = F.sum((F.col("gap") + F.col("length")).cast("long")).over(so_far)
    return (
        every.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("length"))
        .filter("counts")
        .select("row", "owner", "repository", "kind", "start", "end", "hash")
    )


def _ownership(candidates: DataFrame) -> DataFrame:
    """``hash`` with its numbers of different owners and repositories; nulls are one each."""
    held = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
    )


def find_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", wide: int = WIDE
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_<kind>`` of every kind, ``spans`` (start, kind,
    end, owners and repositories of each secret, by start and kind), ``n_live`` and
    ``n_example`` of them. Places are code points, ends exclusive.

    Null and empty texts hold nothing. Null owners are one owner, and so are null repositories.
    Repeated rows are rows of their own of one repository. Further columns are ignored; an empty
    table gives an empty result.
    """
    scanned = _scan(docs, owner, repository)
    candidates = stored(_candidates(scanned), "secret-candidates")
    judged = candidates.join(stored(_ownership(candidates), "secret-owners"), "hash")
    added = [list(KINDS).index(kind) for kind in ADDED]
    kept = judged.filter(~F.col("kind").isin(added) | (F.col("owners") < wide))
    span = F.struct("start", "kind", "end", "owners", "repositories")
    by_row = kept.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(f"array<{_SPAN}>"))

    def count(number: int, kind: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == number)
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [count(number, kind) for number, kind in enumerate(KINDS)]
    live = F.size(F.filter("spans", lambda s: s["owners"] < wide)).cast("long")
    return (
        scanned.select("row", "doc_id")
        .join(by_row, "row", "left")
        .select("doc_id", spans.alias("spans"))
        .select(
            "doc_id",
            *counts,
            "spans",
            live.alias("n_live"),
            (F.size("spans") - live).cast("long").alias("n_example"),
        )
    )


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    numbers = [list(KINDS).index(k) for k in kinds]
    chosen = F.filter(spans, lambda s: s["kind"].isin(numbers))
    parts = F.transform(
        chosen,
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")
