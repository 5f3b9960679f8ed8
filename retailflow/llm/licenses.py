"""License scans by exact set-similarity join (operator 8).

A text block is a line, and also each run of lines that a template goes on through: among the
``EDGE`` words on either side of a line's end stand two that the template has in this order, as
far apart as in the text or up to ``LEFT_OUT`` words more. So hard-wrapped notices are whole
blocks, also with a comment mark or a changed word at the break. A block meets a template if it
holds the share ``CONTAINMENT`` of the template's different words. Words are put in the order of
how many blocks hold them in the whole corpus, rarest first. With a template of t words and need = ceil(share * t):

* length filter: a block with fewer than ``need`` template words cannot meet it;
* prefix filter: the rarest t - need + 1 words of the template and the rarest b - need + 1 of the
  block's b template words share one, so these are joined;
* positional filter: after a shared word at places i and j, what follows must still suffice:
  1 + min(t - i, b - j) - 1 >= need, counted from the pair's first shared words.

What passes is verified by the whole overlap. Beside the method, the base looks for the
contract's phrases as words in a row. Only DataFrame functions are used: one scan writes what
later steps need of each document, a few numbers, and no text is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.llm.common import row_number, stored

CONTAINMENT = 0.8
#: Words on either side of a line's end that are looked at; words left out between two of them.
EDGE, LEFT_OUT = 2, 2

# The phrases of the base scan with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Common notices of public licenses, as their texts recommend them.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "cc": [
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
}

# Function words, which say nothing about a license.
COMMON = (
    "a and any are as by following for in is it may met not of on or subject that the to under "
    "v with without you"
).split()
#: Words of a notice as it may stand in a text, against its template.
STRETCH = 1.25

#: Between words: ASCII that is neither a digit nor a letter.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


_PLACES = "array<struct<at:int,label:string>>"


def _words(text: Column) -> Column:
    """The words as they stand; those of ASCII letters are to be compared without case."""
    return F.array_remove(F.split(text, _BETWEEN, -1), "")


def _phrase_pattern(phrase: str) -> str:
    return f"(?<!{_WORD}){_BETWEEN.join(phrase.split())}(?!{_WORD})"


def _lower(words: Column) -> Column:
    """A-Z in lower case; words with other letters keep theirs, as no template has any."""
    return F.transform(words, lambda w: F.when(w.rlike("^[0-9A-Za-z]+$"), F.lower(w)).otherwise(w))


def _places(words: Column, phrases: dict[str, str]) -> Column:
    """(place, label) of every place of every phrase, by the places where its words stand."""
    def of(phrase: str, label: str) -> Column:
        parts = phrase.split()
        tests = F.when(
            F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts))
        ).otherwise(F.array().cast("array<int>"))

        def stands(i):
            same = F.lit(True)
            for k, part in enumerate(parts):
                same &= F.get(words, i + k) == part
            return same

        return F.transform(
            F.filter(tests, stands), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label"))
        )

    found = [of(phrase, label) for phrase, label in phrases.items()]
    return F.concat(*found)


def _template_rows(templates: dict[str, list[str]]) -> list[tuple[int, str, list[str]]]:
    flat = [(label, text) for label, texts in templates.items() for text in texts]
    return [(k, label, sorted(set(text.split()))) for k, (label, text) in enumerate(flat)]


def reach(templates: list[str]) -> int:
    """The words that the longest template may take in a text."""
    return math.ceil(STRETCH * max(len(text.split()) for text in templates))


def _cut(blocks: Column, size: int) -> Column:
    """``blocks`` (arrays of words), the long ones as blocks of ``2 * size`` words that overlap
    by half, in which any ``size`` words in a row are together."""
    return F.flatten(
        F.transform(
            blocks,
            lambda words: F.when(F.size(words) <= 2 * size, F.array(words)).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - size - 1, F.lit(size)),
                    lambda k: F.slice(words, k + 1, F.lit(2 * size)),
                )
            ),
        )
    )


def _need(words: list, share: float) -> int:
    """How many of a template's different words meet it."""
    return math.ceil(share * len(words) - 1e-9)


def _pairs(templates: list[str]) -> list[str]:
    """Words a and b by which a template goes on if i words stand between a and the line's end
    and j before b on the next line: ``i j a b``.

    A word before b may be a comment's mark; one after a stands for a word of the template.
    """
    pairs = set()
    for text in templates:
        words = text.split()
        for k, a in enumerate(words):
            for i in range(EDGE):
                for j in range(EDGE):
                    after = words[k + i + 1 : k + i + j + 2 + LEFT_OUT]
                    pairs |= {f"{i} {j} {a} {b}" for b in after}
    return sorted(pairs)


def _runs(lines: Column, pairs: list[str]) -> Column:
    """The words of each run of two ``lines`` or more that a template goes on through."""
    known = F.split(F.lit("\n".join(pairs)), "\n")

    def goes_on(k: Column) -> Column:
        """Whether line ``k`` continues the line before it."""
        before, line = F.get(lines, k - 1), F.get(lines, k)
        beside = F.array(
            *[
                F.concat_ws(
                    " ",
                    F.lit(f"{i} {j}"),
                    F.get(before, F.size(before) - 1 - i),
                    F.get(line, F.lit(j)),
                )
                for i in range(EDGE)
                for j in range(EDGE)
            ]
        )
        return F.coalesce(F.arrays_overlap(beside, known), F.lit(False))

    starts = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1), lambda k: (k == 0) | ~goes_on(k)
    )
    ends = F.concat(F.slice(starts, 2, F.size(lines)), F.array(F.size(lines)))
    several = F.filter(
        F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda x: x["end"] - x["start"] > 1
    )
    return F.transform(
        several, lambda x: F.flatten(F.slice(lines, x["start"] + 1, x["end"] - x["start"]))
    )


def _scan(
    docs: DataFrame, phrases: dict[str, str], templates: dict[str, list[str]], share: float
) -> DataFrame:
    """One row for each document: its number of words, the places of phrases, and for each of
    its blocks the template words in it, lines before runs of lines."""
    texts = [text for label in templates.values() for text in label]
    sets = [words for *_, words in _template_rows(templates)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    anywhere = "(?i)" + "|".join(f"(?:{_phrase_pattern(p)})" for p in phrases)
    places = F.when(F.col("words").isNotNull(), _places(F.col("words"), phrases))
    known = F.array(*[F.lit(w) for w in sorted({w for words in sets for w in words})])
    size = reach(texts)

    whole = F.transform(
        F.split(F.lower("text"), "\n", -1),
        lambda line: F.when(
            # 2 * size words have as many letters and a sign between each: no cut is needed.
            F.length(line) < 4 * size, F.array(F.split(line, _BETWEEN, -1))
        ).otherwise(_cut(F.array(F.array_remove(F.split(line, _BETWEEN, -1), "")), size)),
    )
    blocks = F.filter(
        F.transform(F.flatten(whole), lambda words: F.array_intersect(words, known)),
        lambda words: F.size(words) > 0,
    )
    # A text with too few words of every template has no run that meets one.
    enough = F.lit(False)
    for words in sets:
        wanted = F.array(*[F.lit(w) for w in words])
        enough |= F.size(F.array_intersect(F.flatten("blocks"), wanted)) >= _need(words, share)
    lines = F.transform(
        F.split(F.lower("text"), "\n", -1),
        lambda line: F.array_remove(F.split(line, _BETWEEN, -1), ""),
    )
    runs = F.when(
        F.col("lines").isNotNull(),
        F.transform(
            _cut(_runs(F.col("lines"), _pairs(texts)), size),
            lambda x: F.array_intersect(x, known),
        ),
    )
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    ).select("doc_id", "text", F.inline(F.array(F.struct(_words(F.col("text")).alias("words")))))
    lowered = split.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.inline(
            F.array(
                F.struct(
                    F.when(F.col("text").rlike(anywhere), _lower(F.col("words"))).alias("words"),
                    blocks.alias("blocks"),
                )
            )
        ),
    ).select(
        "doc_id",
        "n_words",
        "words",
        "blocks",
        F.inline(F.array(F.struct(F.when(enough, lines).alias("lines")))),
    )
    return stored(
        lowered.select(
            row_number().alias("row"),
            "doc_id",
            "n_words",
            F.coalesce(places, F.array().cast(_PLACES)).alias("places"),
            F.concat("blocks", F.coalesce(runs, F.array().cast("array<array<string>>"))).alias(
                "blocks"
            ),
        ),
        "license-scan",
    )


def _meeting(
    blocks: DataFrame, templates: list[tuple[int, str, list[str]]], share: float
) -> DataFrame:
    """``row``, ``block``, ``label`` and ``containment`` of the blocks that meet a template.

    ``blocks`` has ``row``, ``block`` and ``words``, the block's different template words.
    """
    spark = blocks.sparkSession
    # A row for each word of the fixed templates, at most.
    counted = (
        blocks.select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    often = {r["word"]: r["n"] for r in counted}
    order = {
        w: k
        for k, w in enumerate(
            sorted({w for _, _, ws in templates for w in ws}, key=lambda w: (often.get(w, 0), w))
        )
    }
    prefixes = []
    for key, label, words in templates:
        ranks = sorted(order[w] for w in words)
        need = _need(ranks, share)
        prefixes += [
            (key, label, rank, place, len(ranks), need)
            for place, rank in enumerate(ranks[: len(ranks) - need + 1])
        ]
    names = "template int, label string, rank int, i int, t int, need int"
    prefix = spark.createDataFrame(prefixes, names)
    least = min(need for *_, need in prefixes)
    # Fixed tables: their size follows from the templates alone.
    ranks = F.create_map(*[F.lit(x) for w, k in order.items() for x in (w, k)])
    sets = spark.createDataFrame(
        [
            (
                k,
                sorted(order[w] for w in words),
                sorted(order[w] for w in words if w not in COMMON),
            )
            for k, _, words in templates
        ],
        "template int, set array<int>, telling array<int>",
    )
    sized = (
        blocks.filter(F.size("words") >= least)
        .select(
            "row",
            "block",
            F.sort_array(F.transform("words", lambda w: F.element_at(ranks, w))).alias("set"),
        )
        .withColumn("b", F.size("set"))
    )
    prefix_of_block = F.slice("set", 1, F.col("b") - least + 1)
    prefixed = sized.select(
        "row", "block", "set", "b", F.posexplode(prefix_of_block).alias("j", "rank")
    )
    candidates = (
        prefixed.join(F.broadcast(prefix), "rank")
        .filter("b >= need AND j <= b - need AND least(t - i, b - j) >= need")
        .groupBy("row", "block", "template")
        .agg(F.first("set").alias("block_set"), F.first("label").alias("label"))
    )
    def held(words: str) -> Column:
        return F.size(F.array_intersect("block_set", words))

    return (
        candidates.join(F.broadcast(sets), "template")
        .filter(held("telling") >= share * F.size("telling") - 1e-9)
        .select("row", "block", "label", (held("set") / F.size("set")).alias("containment"))
        .filter(F.col("containment") >= share - 1e-9)
    )


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, list[str]] | None = None,
    share: float = CONTAINMENT,
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_words``, ``n_base`` (places of phrases),
    ``first_word`` and ``last_word`` (the least and greatest word they start at; null without),
    ``base_labels``, ``labels`` (with those of the templates met; both different, sorted,
    comma-joined), ``score`` (the greatest containment met, 1 for a phrase, else 0) and
    ``blocks`` (the numbers of the blocks that meet one; the lines with a template word come
    first, then the runs of lines that a template goes on through).

    Null and empty texts have no words and no labels. Null and repeated doc_ids are rows of
    their own, further columns are ignored, and an empty table gives an empty result.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    rows = _template_rows(templates)
    scanned = _scan(docs, phrases, templates, share)
    blocks = scanned.select("row", F.posexplode("blocks").alias("block", "words"))
    met = (
        _meeting(blocks, rows, share)
        .groupBy("row")
        .agg(
            F.collect_set("label").alias("met"),
            F.max("containment").alias("containment"),
            F.sort_array(F.collect_set("block")).alias("blocks"),
        )
    )
    base = F.sort_array(F.array_distinct(F.transform("places", lambda p: p["label"])))
    empty = F.array().cast("array<string>")
    return scanned.select("row", "doc_id", "n_words", "places").join(met, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").cast("long").alias("first_word"),
        F.array_max("places.at").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(
            F.sort_array(F.array_union(base, F.coalesce("met", empty))), ","
        ).alias("labels"),
        F.when(F.size("places") > 0, 1.0)
        .otherwise(F.coalesce("containment", F.lit(0.0)))
        .alias("score"),
        F.coalesce("blocks", F.array().cast("array<int>")).alias("blocks"),
    )
