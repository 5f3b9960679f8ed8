"""Fill-in-middle against tokens cut one by one, and the exact way back."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from retailflow.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < spm:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), output


def rows(frame):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return sorted(map(repr, (tuple(r) for r in frame.select(*names).collect())))


ODD = [
    "<P", "a<", "<P>", "x <M> y", "$1 \\2 $ {3}", "<S<S <P<M M>>", "\n\n a\r\n b \n", "a\n", "\x85a b c\n",
    "😀 é漢字 \U0001f600\x0bz", "one", " ", "\\", "< P> <", "a b <S", "P> a", "(?s){2} [x]*+",
]


def test_odd_texts(spark):
    data = [(k, ODD[k % len(ODD)]) for k in range(len(ODD) * 25)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    made = fim.transform(docs)
    assert rows(made) == sorted(repr(brute(*d)) for d in data)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, back.collect())) == sorted(data)
    assert {r["form"] for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_messy_rows(messy, messy_rows):
    wanted = sorted(repr(brute(r[0], r[1], rate=100)) for r in messy_rows)
    assert rows(fim.transform(messy, rate=100)) == wanted


def test_very_long_texts(spark):
    texts = ["w " * 1_500_000, " " * 3_000_000, "x" * 3_000_000, "ab\n" * 900_000 + "  "]
    data = [(10 * j + k, t) for j in range(2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([], "doc_id long, text string")
    for doc_id, text in data:
        part, times = next(
            (p, len(text) // len(p)) for p in ("w ", " ", "x", "ab\n") if text.startswith(p)
        )
        tail = text[len(part) * times :]
        row = spark.range(doc_id, doc_id + 1).select(
            F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit(part), times), F.lit(tail)).alias("text")
        )
        docs = docs.union(row)
    wanted = [brute(*d, rate=100) for d in data]
    found = fim.transform(docs, rate=100).withColumn("output", F.sha2("output", 256))
    digests = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for w in wanted]
    assert rows(found) == sorted(map(repr, digests))


def test_null_and_repeated_ids(spark):
    data = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, None), (7, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(fim.transform(docs, rate=100)) == sorted(repr(brute(*d, rate=100)) for d in data)


def test_empty_table(nothing):
    assert fim.transform(nothing).count() == 0


@pytest.mark.parametrize("seed, rate, spm", [(42, 50, 80), (1, 100, 0)])
def test_documents(spark, small_documents, seed, rate, spm):
    docs = spark.createDataFrame(
        [(d["doc_id"], d["text"]) for d in small_documents], "doc_id long, text string"
    )
    wanted = sorted(repr(brute(d["doc_id"], d["text"], seed, rate, spm)) for d in small_documents)
    assert rows(fim.transform(docs, seed, rate, spm)) == wanted
