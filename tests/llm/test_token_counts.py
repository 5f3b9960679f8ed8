"""Token counts against the library over whole texts."""

import functools
import random
import time

import pytest

from retailflow.llm import common, token_counts

PATH = common.vocabulary("word_bpe_49k.json")


@functools.cache
def library():
    return common.tokenizer(PATH)


def plain(text):
    return len(library().encode(text or "", add_special_tokens=False).ids)


def test_messy_rows(messy, messy_rows):
    found = token_counts.token_counts(messy).collect()
    wanted = [(r[0], len((r[1] or "").encode()), plain(r[1]), plain(r[1]) > 2048) for r in messy_rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_chunks_splice_to_the_whole():
    rng = random.Random(3)
    counts = token_counts.WordCounts(library())
    alphabets = ["ab é'st\n\t.!", "abc", "ab1 ", "漢字 。", "漢かカ한。，ﾞ\u3099", "か\u3099カ、！'s<|", "a\x1c \x85é́", "<|endoftext|> "]
    for n in range(400):
        text = "".join(rng.choices(rng.choice(alphabets), k=rng.randrange(30, 400)))
        found = token_counts.count(text, counts, chunk=rng.choice((20, 50, 90)), overlap=8)
        assert found == plain(text), (n, text)


@pytest.mark.parametrize("part", ["漢字かな", "漢字、かな。", "абв", "a!", "ไทย", "é"])
def test_long_texts_without_ascii_space(part):
    """At the real chunk size, equal to the library and within a few times its own time."""
    text = part * (1_000_000 // len(part))
    begin = time.monotonic()
    wanted = plain(text)
    alone = time.monotonic() - begin
    counts = token_counts.WordCounts(library())
    begin = time.monotonic()
    assert token_counts.count(text, counts) == wanted
    assert time.monotonic() - begin < 5 * alone + 1


def test_words_of_every_space():
    counts = token_counts.WordCounts(library())
    for code in (*range(0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x202F, 0x3000):
        for text in (f"a{chr(code)}b", f"!{chr(code)}?", f"{chr(code)}́ x{chr(code)}"):
            assert token_counts.count(text, counts) == plain(text), hex(code)


def test_empty_table(nothing):
    assert token_counts.token_counts(nothing).count() == 0


def test_query(spark, llm_tables):
    import __spark_entry__

    found = __spark_entry__.queries()["op4_token_counts"](spark, llm_tables).collect()
    docs = spark.read.parquet(f"{llm_tables}/documents.parquet").select("doc_id", "text").collect()
    wanted = {d["doc_id"]: (len(d["text"].encode()), plain(d["text"])) for d in docs}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in found} == wanted
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in found)
