"""Line dedup with a suffix array over line-ID sequences (operator 3).

A text's lines that hold a word are a sequence of line ids: hashes of the line without outer
white space. Suffixes are ranked by distributed prefix doubling: the rank of a suffix by its
first 2h lines is the place of the pair (rank by h, rank by h of the suffix h lines on) in a
global sort of the different pairs. A suffix whose first h lines stand nowhere else has its
final place, leaves the table, and takes no part in later rounds; what stays are the repeats.

The suffixes that share their first w lines stand side by side in that array: the
longest-common-prefix interval of depth w. Its members are those that share the pair (rank by p,
rank by p of the suffix w - p lines on) for the greatest power of two p <= w, the constant-time
test of prefix doubling, so no scan along the array is needed. In each interval the first
member is the original and the others are later copies.

A run counts from ``min_words`` words on. Every maximal repeated run of that size is covered
by the shortest runs of that size that begin or end at each of its lines, so the intervals
looked up are those of these shortest runs, at most two for a line, none longer than
``min_words`` lines. That bounds the rounds as well, whatever the length of the repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from retailflow.llm.common import checkpointed, row_number, stored

MIN_WORDS = 50

_WORDS = r"[^\x20\x09-\x0D]+"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _lined(row: Column, doc_id: Column, text: Column) -> list[Column]:
    """``row``, ``doc_id`` and ``lines``: of each line with a word its place among all lines,
    its id and its number of words."""
    # Not by a pattern: one that looks for the end tries every place of a long inner run.
    outer = F.lit(" \t\n\x0b\f\r")
    trimmed = F.transform(
        _lines(text),
        lambda x, k: F.struct(k.alias("line"), F.btrim(x, outer).alias("value")),
    )
    lines = F.transform(
        F.filter(trimmed, lambda x: x["value"] != ""),
        lambda x: F.struct(
            x["line"].alias("line"),
            F.xxhash64(x["value"]).alias("id"),
            F.size(F.split(x["value"], r"[\x20\x09-\x0D]+")).alias("words"),
        ),
    )
    return [row.alias("row"), doc_id.cast("long").alias("doc_id"), lines.alias("lines")]


def _line_rows(lined: DataFrame) -> DataFrame:
    """A row for each line with a word; ``at`` is its place among these."""
    return lined.select("row", F.posexplode("lines").alias("at", "l")).select("row", "at", "l.*")


def _ranked(pairs: DataFrame, name: str) -> DataFrame:
    """``row``, ``at``, ``rank`` of the suffixes whose pair (r1, r2) is not the only one.

    Ranks are in the order of the pairs, as a global sort gives them; they have gaps.
    """
    groups = pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sort = groups.orderBy("r1", "r2").select("r1", "r2", row_number().alias("rank"))
    sorted_pairs = stored(sort, f"{name}-pairs")
    return stored(pairs.join(sorted_pairs, ["r1", "r2"]).select("row", "at", "rank"), name)


def suffix_ranks(lines: DataFrame, longest: int) -> dict[int, DataFrame]:
    """For h = 1, 2, 4 ... up to ``longest`` the ranks by the first h lines of all suffixes
    that share these lines with another one."""
    first = lines.select("row", "at", F.col("id").alias("r1"), F.lit(0).alias("r2"))
    ranks, h = {1: _ranked(first, "suffix-ranks-1")}, 1
    while 2 * h <= longest:
        later = ranks[h].select("row", (F.col("at") - h).alias("at"), F.col("rank").alias("r2"))
        pairs = ranks[h].withColumnRenamed("rank", "r1").join(later, ["row", "at"])
        h *= 2
        ranks[h] = _ranked(pairs, f"suffix-ranks-{h}")
        if ranks[h].isEmpty():
            break
    return ranks


def _shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``row``, ``at``, ``w``: the shortest runs of ``min_words`` words from and to each line.

    With before(i) the words ahead of line i, the run from i ends at the first line whose
    words up to and with it reach before(i) + min_words; both are places in one sequence, so a
    union and a window find them.
    """
    order = Window.partitionBy("row").orderBy("at")
    totals = lines.select(
        "row", "at", "words", F.sum("words").over(order).alias("upto")
    ).withColumn("before", F.col("upto") - F.col("words"))
    # Sorted by the number of words, a line's end stands before a threshold it reaches.
    upto = (Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("row").orderBy(F.desc("key"), F.desc("mark")).rowsBetween(*upto)
    behind = Window.partitionBy("row").orderBy("key", "mark").rowsBetween(*upto)
    ends = totals.select("row", "at", F.col("upto").alias("key"), F.lit(1).alias("mark"))
    starts = totals.select(
        "row", "at", (F.col("before") + min_words).alias("key"), F.lit(0).alias("mark")
    )
    forward = (
        starts.union(ends)
        .withColumn("other", F.min(F.when(F.col("mark") == 1, F.col("at"))).over(ahead))
        .filter("mark = 0 AND other IS NOT NULL")
        .select("row", "at", (F.col("other") - F.col("at") + 1).alias("w"))
    )
    begins = totals.select("row", "at", F.col("before").alias("key"), F.lit(0).alias("mark"))
    stops = totals.select(
        "row", "at", (F.col("upto") - min_words).alias("key"), F.lit(1).alias("mark")
    )
    backward = (
        begins.union(stops)
        .withColumn("other", F.max(F.when(F.col("mark") == 0, F.col("at"))).over(behind))
        .filter("mark = 1 AND other IS NOT NULL")
        .select("row", F.col("other").alias("at"), (F.col("at") - F.col("other") + 1).alias("w"))
    )
    return forward.union(backward).distinct()


def repeated_runs(lined: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row``, ``at``, ``w`` of the shortest repeated runs, ``first`` (doc_id, row and place of
    the original: the least doc_id, nulls last, then the first row), and ``copy``, whether the
    run is a later copy."""
    lines = _line_rows(lined)
    runs = stored(_shortest_runs(lines, min_words), "shortest-runs")
    found = None
    for power, ranks in suffix_ranks(lines, min_words).items():
        level = runs.filter((F.col("w") >= power) & (F.col("w") < 2 * power))
        tail = ranks.select("row", F.col("at").alias("last"), F.col("rank").alias("r2"))
        named = (
            level.join(ranks.withColumnRenamed("rank", "r1"), ["row", "at"])
            .withColumn("last", F.col("at") + F.col("w") - power)
            .join(tail, ["row", "last"])
            .select("row", "at", "w", "r1", "r2")
        )
        found = named if found is None else found.union(named)
    # The order of a struct puts nulls first, so the test comes before the number.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "at").alias("place")
    ids = lined.select("row", "doc_id")
    found = stored(found.join(ids, "row").select("w", "r1", "r2", place), "run-names")
    firsts = (
        found.groupBy("w", "r1", "r2")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    # Stored, so that the join is on rows as they come: Spark splits a run with many copies,
    # which it cannot where the join shares the aggregation's partitions.
    firsts = stored(firsts, "run-firsts")
    return found.join(firsts, ["w", "r1", "r2"]).select(
        "place.row",
        "place.at",
        "w",
        "first",
        (~F.col("place").eqNullSafe(F.col("first"))).alias("copy"),
    )


def _deleted(lined: DataFrame, min_words: int) -> DataFrame:
    """``row`` and ``lines``: the places, among all lines, of the lines to delete."""
    copies = repeated_runs(lined, min_words).filter("copy")
    covered = copies.select(
        "row", F.explode(F.expr("sequence(at, at + w - 1)")).alias("at")
    ).distinct()
    return (
        covered.join(_line_rows(lined).select("row", "at", "line", "words"), ["row", "at"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"), F.sum("words").alias("words"))
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of repeated line runs of ``min_words`` words or more.

    A line's copy is one that agrees without outer white space. The first copy, of the
    least doc_id (nulls last), stays; runs may repeat in one text. Only deleted lines go, with their line feed;
    empty lines stay. ``n_chars``, where there, is that of the new text. A row that loses all
    its words is left out; a row that had none, null texts included, is kept as it is, and so
    are null and repeated doc_ids. Further columns are kept, whatever their names.
    """
    rows = checkpointed(docs.select(row_number().alias("row"), F.struct("*").alias("doc")))
    columns = _lined(F.col("row"), F.col("doc.doc_id"), F.col("doc.text"))
    lined = stored(rows.select(*columns), "lines")
    cut = _deleted(lined, min_words).select("row", F.col("lines").alias("cut"))
    # Whether each line stays, built from the gaps between deleted ones: linear in the lines.
    before = F.slice(F.concat(F.array(F.lit(-1)), "cut"), 1, F.size("cut"))
    flags = F.flatten(
        F.transform(
            F.zip_with("cut", before, lambda at, last: at - last - 1),
            lambda gap: F.concat(F.array_repeat(F.lit(True), gap), F.array(F.lit(False))),
        )
    )
    lines_left = F.zip_with(
        _lines(F.col("doc.text")), flags, lambda x, stays: F.when(F.coalesce(stays, F.lit(True)), x)
    )
    text = F.concat_ws("\n", F.filter(lines_left, lambda x: x.isNotNull()))
    joined = rows.join(cut, "row", "left").withColumn(
        "new", F.when(F.col("cut").isNull(), F.col("doc.text")).otherwise(text)
    )
    kept = joined.filter(F.col("cut").isNull() | F.col("new").rlike(_WORDS))
    made = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    columns = [
        F.when(F.col("cut").isNull(), F.col(f"doc.`{f.name}`"))
        .otherwise(made[f.name].cast(f.dataType))
        .alias(f.name)
        if f.name in made
        else F.col(f"doc.`{f.name}`").alias(f.name)
        for f in docs.schema
    ]
    return kept.select(*columns)


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n_lines`` with a word, ``n_deleted`` and
    ``words_deleted`` in later copies, and ``deleted``, their places among all lines."""
    columns = _lined(row_number(), F.col("doc_id"), F.col("text"))
    lined = stored(docs.select(*columns), "lines")
    cut = _deleted(lined, min_words).withColumnRenamed("lines", "cut")
    return (
        lined.select("row", "doc_id", F.size("lines").cast("long").alias("n_lines"))
        .join(cut, "row", "left")
        .select(
            "doc_id",
            "n_lines",
            F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_deleted"),
            F.coalesce("words", F.lit(0)).cast("long").alias("words_deleted"),
            F.concat_ws(",", F.transform("cut", lambda x: x.cast("string"))).alias("deleted"),
        )
    )
