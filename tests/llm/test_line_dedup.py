"""Line dedup against maximal repeated runs found pair by pair."""

import random
import re

import pytest
from pyspark.sql import functions as F

from retailflow.llm import line_dedup

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def split(text):
    """(place, content, words) of the lines with a word."""
    lines = [(k, x.strip(SPACE)) for k, x in enumerate((text or "").split("\n"))]
    return [(k, x, len(re.split(f"[{SPACE}]+", x))) for k, x in lines if x]


def brute(docs, min_words):
    """Per row the places of lines in later copies of maximal runs; docs in order of age."""
    rows = [split(t) for _, t in docs]
    deleted = [set() for _ in rows]
    for r, own in enumerate(rows):
        for i in range(len(own)):
            for q in range(r + 1):
                for j in range(i if q == r else len(rows[q])):
                    n = 0
                    while (
                        i + n < len(own) and j + n < len(rows[q]) and own[i + n][1] == rows[q][j + n][1]
                    ):
                        n += 1
                    if n and sum(x[2] for x in own[i : i + n]) >= min_words:
                        deleted[r] |= {x[0] for x in own[i : i + n]}
    return deleted


def report(docs, min_words):
    found = []
    for (doc_id, text), gone in zip(docs, brute(docs, min_words), strict=True):
        lines = split(text)
        words = sum(n for k, _, n in lines if k in gone)
        places = ",".join(map(str, sorted(gone)))
        found.append(str((doc_id, len(lines), len(gone), words, places)))
    return sorted(found)


def rows(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


def by_age(pairs):
    return sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))


@pytest.mark.parametrize("min_words", [1, 5, 12])
def test_random_lines(spark, min_words):
    rng = random.Random(min_words)
    lines = ["a b c", "d", " d e ", "f g h i", "a  b", "", " "]
    docs = [(k, "\n".join(rng.choices(lines, k=rng.randrange(0, 14)))) for k in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(line_dedup.line_report(frame, min_words)) == report(docs, min_words)


def test_messy_rows(spark, messy, messy_rows):
    # rows of one doc_id are of one age, so which of them is the copy is open: leave it out
    docs = by_age([(r[0], r[1]) for r in messy_rows[:-1]])
    frame = messy.filter("NOT (doc_id <=> 3 AND text LIKE '*%')")
    for min_words in (4, 50):
        assert rows(line_dedup.line_report(frame, min_words)) == report(docs, min_words)


def test_text_without_the_copies(spark, messy, messy_rows):
    kept = line_dedup.dedup_lines(messy, 50)
    assert kept.columns == messy.columns
    docs = by_age([(r[0], r[1]) for r in messy_rows])
    wanted = []
    for (doc_id, text), gone in zip(docs, brute(docs, 50), strict=True):
        left = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone)
        if not gone:
            wanted.append(str((doc_id, text, 5)))
        elif left.strip(SPACE):
            wanted.append(str((doc_id, left, len(left))))
    assert rows(kept.select("doc_id", "text", "n_chars")) == sorted(wanted)


def test_ranks_are_in_suffix_order(spark):
    rng = random.Random(2)
    texts = ["\n".join(rng.choices("abc", k=rng.randrange(1, 12))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = line_dedup._lined(F.col("doc_id"), F.col("doc_id"), F.col("text"))
    lines = line_dedup._line_rows(docs.select(*columns))
    ids = {}
    for r in lines.collect():
        ids.setdefault(r["row"], {})[r["at"]] = r["id"]
    for h, ranks in line_dedup.suffix_ranks(lines, 4).items():
        found = [
            (r["rank"], [ids[r["row"]][r["at"] + k] for k in range(h)]) for r in ranks.collect()
        ]
        by_prefix = sorted(found, key=lambda x: x[1])
        assert [a for a, _ in by_prefix] == sorted(a for a, _ in found)
        assert len({a for a, _ in found}) == len({tuple(b) for _, b in found})


def test_query(spark, small_documents):
    import __spark_entry__

    docs = by_age([(d["doc_id"], d["text"]) for d in small_documents])
    found = __spark_entry__.queries()["op3_line_dedup"](spark, "/root/testdata/sf0.001")
    assert rows(found) == report(docs, line_dedup.MIN_WORDS)
    assert found.filter(F.col("n_deleted") > 0).count() > 0


def test_empty_table(nothing):
    assert line_dedup.line_report(nothing).count() == 0
    assert line_dedup.dedup_lines(nothing).count() == 0
