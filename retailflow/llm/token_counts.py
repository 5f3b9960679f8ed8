"""Token counts with overlap resynchronisation for huge documents (operator 4).

A text longer than ``CHUNK`` characters is encoded in overlapping chunks with offsets. Two
neighbours are spliced at a boundary in their overlap that is stable whatever stands on
either side, and around which both encodings agree; without one the overlap is doubled, up
to the whole left chunk, and then the chunks are joined into one. So a result never rests
on agreement alone.

Stable boundaries of the vocabulary: next to ASCII white space, which is dropped and which
no pre-token, special string or normalised sequence crosses; next to an ASCII digit, which is a
pre-token of its own, is in no special string and composes with nothing; and before CJK
punctuation behind a letter of these scripts, where a run of letters ends and nothing composes.
Where they are is looked up in the text before anything is encoded. A run without any is one
pre-token, which grows to twice its length at a time, so a text of such runs costs a few times
what the library takes for it.

Texts up to ``CHUNK`` are counted by the same rule at every run of white space: the count
of a text is the sum over its words, and a worker keeps the counts of words it has met.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retailflow.llm import common

CHUNK, OVERLAP = 1 << 15, 512
LIMIT = 2048
#: Word counts that a worker keeps; beyond it words are encoded again.
CACHE = 1_000_000
#: Tokens on each side of a splice on which both encodings must agree.
AGREE = 4

#: White space to Python's split but not to the vocabulary's pattern.
_ODD = re.compile("[\x1c-\x1f]")
#: Letters: hiragana and katakana without their combining marks, CJK ideographs, hangul.
_STABLE = re.compile(
    r"[ \t\n\r\f\v0-9]|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3])"
    r"[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f]"
)


class WordCounts(dict):
    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> int:
        found = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self) < CACHE and len(word) < 64:
            self[word] = found
        return found


def _encoded(tokenizer, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """(start, end, id) of each token of a chunk, by places in the whole text."""
    made = tokenizer.encode(text[start:end], add_special_tokens=False)
    return [(a + start, b + start, i) for (a, b), i in zip(made.offsets, made.ids, strict=True)]


def _marks(text: str, start: int, end: int) -> list[int]:
    """The stable boundaries inside text[start:end], the nearest to its middle first."""
    middle = (start + end) // 2
    found = (m.start() for m in _STABLE.finditer(text, start + 1, end - 1))
    return sorted(found, key=lambda at: abs(at - middle))


def _splice(marks: list[int], left: list, right: list, start: int, end: int) -> int | None:
    """The first of the marks around which both encodings of text[start:end] agree."""
    starts = [[t[0] for t in tokens] for tokens in (left, right)]
    for at in marks:
        sides = []
        for tokens, places in zip((left, right), starts, strict=True):
            k = bisect_left(places, at)
            before = [t for t in tokens[max(0, k - AGREE) : k] if start < t[0] and t[1] <= at]
            after = [t for t in tokens[k : k + AGREE] if t[1] < end]
            sides.append((before, after))
        (b1, a1), (b2, a2) = sides
        near = min(len(b1), len(b2))
        after = min(len(a1), len(a2))
        if near and after and b1[-near:] == b2[-near:] and a1[:after] == a2[:after]:
            return at
    return None


def count_chunked(tokenizer, text: str, chunk: int, overlap: int) -> int:
    """The number of tokens of a text of any length, a few chunks in memory at a time."""
    total, begin, end = 0, 0, min(chunk, len(text))
    left = _encoded(tokenizer, text, begin, end)
    while end < len(text):
        width, at = min(overlap, end - begin), None
        while True:
            start, stop = end - width, min(end + chunk, len(text))
            marks = _marks(text, start, end)
            if marks:
                right = _encoded(tokenizer, text, start, stop)
                at = _splice(
                    marks,
                    left[bisect_left(left, start, key=lambda t: t[1]) :],
                    right[: bisect_left(right, end, key=lambda t: t[0])],
                    start,
                    end,
                )
            if at is not None or start == begin:
                break
            width = min(2 * width, end - begin)
        if at is None:  # no stable boundary in the whole left chunk: it doubles
            end = min(end + max(chunk, end - begin), len(text))
            left = _encoded(tokenizer, text, begin, end)
        else:
            total += bisect_left(left, at, key=lambda t: t[0])
            left = right[bisect_left(right, at, key=lambda t: t[0]) :]
            begin, end = at, stop
    return total + len(left)


def count(text: str, words: WordCounts, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    if len(text) > chunk:
        return count_chunked(words.tokenizer, text, chunk, overlap)
    if _ODD.search(text):
        return words.__missing__(text)
    return sum(map(words.__getitem__, text.split()))


def token_counts(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    Null texts count as empty: 0 bytes, 0 tokens. Each row is counted by itself, so a null
    or repeated ``doc_id`` is kept as it is; further columns are ignored; an empty table
    gives an empty result.
    """
    path = vocabulary_path or common.vocabulary("word_bpe_49k.json")

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordCounts(common.tokenizer(path))
        for texts in batches:
            counts = [count(t.as_py() or "", words, chunk, overlap) for t in texts]
            yield pa.array(counts, pa.int64())

    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
