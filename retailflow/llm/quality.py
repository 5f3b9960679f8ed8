"""Quality rules by cross-document line frequency (operator 9).

A line's key is the hash of its words in lower case with digits as 0. On every host, the
distinct documents that hold a line are counted, equal texts being one document. A line in more
than ``LEAST`` of a host's documents is boilerplate there, whatever the host's size. A host of up
to ``LEAST`` documents cannot reach that: its boilerplate is a line in more than ``SMALL_SHARE``
of them, and in ``SMALL_LEAST`` or more. Boilerplate is removed, and a document with less than
``LEFT`` of its words left is depleted and rejected.

One scan takes every document's numbers and its different lines' hashes; texts are not read or
moved again. The counts combine in the tasks before the shuffle, so a line in a third of all
documents is a few rows by then. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.llm.common import row_number, stored

#: Documents of a host that may hold a line; share of its words that a document must keep.
LEAST, LEFT = 20, 0.5
#: Hosts of up to ``LEAST`` documents: share and least number of them that hold a boilerplate line.
SMALL_SHARE, SMALL_LEAST = 0.5, 3
#: Base rules: least words; words of a window; percent of words in repeated windows.
FEW_WORDS, WINDOW, REPEATED = 20, 8, 30

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def _named(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and ``columns``; the latter are made once, however often they are used later.

    A plain projection is merged into those above it, which repeats its expressions.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select(*keep, F.inline(F.array(made)))


def _repeated_words(windows: Column, window: int) -> Column:
    """The words in windows whose hash is in ``windows`` twice or more.

    Sorted by (hash, place), a window is repeated if a neighbour has its hash; its words count
    from where the repeated window before it ends.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    none = F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(None).cast("int").alias("k"))
    before = F.concat(F.array(none), pairs)
    after = F.concat(F.slice(pairs, 2, F.size(windows)), F.array(none))
    same = F.filter(
        F.arrays_zip(pairs.alias("own"), before.alias("before"), after.alias("after")),
        lambda x: (x["own"]["h"] == x["before"]["h"]) | (x["own"]["h"] == x["after"]["h"]),
    )
    places = F.array_sort(F.transform(same, lambda x: x["own"]["k"]))
    # The sum over neighbouring places, with the last place in the state.
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-window).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda s, k: F.struct(
            (s["sum"] + F.least(F.lit(window), k - s["last"])).alias("sum"), k.alias("last")
        ),
        lambda s: s["sum"],
    )


def _scan(docs: DataFrame, host: str, window: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        text.alias("text"),
    )
    rows = _named(
        rows,
        ["doc_id", "host", "text"],
        words=F.array_remove(F.split("text", _SPACE, -1), ""),
        with_word=F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    windows = F.when(
        F.size("words") > window,
        F.transform(
            F.sequence(F.lit(1), F.size("words") - window + 1),
            lambda k: F.xxhash64(F.slice("words", k, window)),
        ),
    )
    rows = _named(
        rows,
        ["doc_id", "host", "text", "with_word"],
        n_words=F.size("words").cast("long"),
        windows=windows,
    )
    keys = F.transform(
        "with_word",
        lambda x: F.struct(
            F.xxhash64(
                F.array_remove(
                    F.split(F.regexp_replace(F.lower(x), "[0-9]", "0"), _SPACE, -1), ""
                )
            ).alias("line"),
            F.size(F.array_remove(F.split(x, _SPACE, -1), "")).alias("words"),
        ),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    return stored(
        rows.select(
            row_number().alias("row"),
            "doc_id",
            "host",
            F.xxhash64("text").alias("content"),
            "n_words",
            F.length(F.regexp_replace("text", _SPACE, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", _SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            (F.size("with_word") - F.size(F.array_distinct("with_word")))
            .cast("long")
            .alias("n_dup_lines"),
            F.coalesce(
                F.when(repeats, _repeated_words(F.col("windows"), window)), F.lit(0)
            ).alias("n_repeat_words"),
            keys.alias("lines"),
        ),
        "quality-scan",
    )


def _boilerplate(scanned: DataFrame, share: float, least: int) -> DataFrame:
    """``host`` and ``line`` of the lines in too many of the host's different documents."""
    texts = scanned.groupBy("host", "content").agg(F.first("lines").alias("lines"))
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    held = texts.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
    often = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    n, documents = F.col("n"), F.col("documents")
    many = n > least
    if share:
        many &= n > share * documents
    else:  # only small hosts' sizes are needed
        sizes = sizes.filter(documents <= least)
    small = (documents <= least) & (n >= SMALL_LEAST) & (n > SMALL_SHARE * documents)
    # Stored, so that the join splits a hot host's lines.
    sizes = stored(sizes, "quality-hosts")
    return (
        often.filter(n > min(least, SMALL_LEAST - 1))
        .alias("a")
        .join(sizes.alias("b"), F.expr("a.host <=> b.host"), "left")
        .filter(many | small)
        .select("a.host", "line")
    )


def assess(
    docs: DataFrame,
    host: str = "source",
    share: float = 0.0,
    least: int = LEAST,
    left: float = LEFT,
    window: int = WINDOW,
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``, ``words_removed`` and
    ``lines_removed`` (the places of boilerplate lines among the lines with a word). With a
    ``share``, a line in more than ``least`` documents must also be in that share of the host's.

    Null texts are empty and fail the base rules; null hosts are one host. Repeated rows are
    judged alike, null doc_ids keep their rows, further columns are ignored, and an empty table
    gives an empty result.
    """
    scanned = _scan(docs, host, window)
    boilerplate = stored(_boilerplate(scanned, share, least), "quality-boilerplate")
    lines = scanned.select("row", "host", F.posexplode("lines").alias("at", "l")).select(
        "row", "host", "at", "l.line", "l.words"
    )
    removed = (
        lines.alias("l")
        .join(
            boilerplate.alias("b"),
            F.expr("l.line = b.line AND l.host <=> b.host"),
        )
        .groupBy("l.row")
        .agg(
            F.sum("l.words").alias("words_removed"),
            F.sort_array(F.collect_list("l.at")).alias("lines_removed"),
        )
    )
    failed = (F.col("n_words") < FEW_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED * F.col("n_words")
    )
    gone = F.coalesce("words_removed", F.lit(0))
    return (
        scanned.drop("lines", "host", "content")
        .join(removed, "row", "left")
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & (F.col("n_words") - gone >= left * F.col("n_words"))).alias("kept"),
            gone.cast("long").alias("words_removed"),
            F.coalesce("lines_removed", F.array().cast("array<int>")).alias("lines_removed"),
        )
    )
