"""Packing: cut the token stream into windows by dynamic programming (operator 1).

Documents stay in their order. The windows' ends are chosen among document ends, sentence
ends and, only inside a sentence longer than ``STRIDE`` tokens, every ``STRIDE`` tokens. A
window costs its padding plus the penalty of its end: 0 after a document, ``SENTENCE``
after a sentence, ``BREAK`` inside one. With f(j) the least cost of everything before end j,

    f(j) = penalty(j) + capacity - at(j) + min over i in reach of (f(i) + at(i)),

so the minimum slides over the ends within ``capacity`` tokens of j, and a queue kept in
increasing order of f(i) + at(i) gives each one in constant time.

Every task packs its own rows as a stream: it solves blocks of ``BLOCK`` tokens, keeps the
windows that end in the first half of the block and solves the rest again with what
follows. It holds one block and one document at a time, shuffles nothing, and a repeated
task cuts the same windows. Padding without a cause in the text is one window per task.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame

from retailflow.llm import common

CAPACITY = 2048
END_ID = 1
SENTENCE, BREAK, STRIDE = 8, 64, 256
BLOCK = 1 << 18
#: A run of this many white-space characters sends its text to the tokenizer library: the
#: faster one backtracks over such a run, a step of its stack for each character.
SPACES = 1 << 12
#: The pre-tokenizer for which PATTERN stands.
BYTE_LEVEL = {
    "type": "ByteLevel",
    "add_prefix_space": False,
    "trim_offsets": True,
    "use_regex": True,
}

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "offset long, ids binary"
)


#: The pre-token pattern of byte-level vocabularies (fixed by them).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _bytes_of_letters() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for.

    Printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(others)}


@functools.cache
def encoder(path: str):
    """A function from a text to its ids, as an array, by the vocabulary in a .json file.

    The tokenizer library makes some 2 MB a second of these texts. Where the k-th merge makes
    the id 256 + k, merging by rank gives the same ids, and tiktoken does so six times as fast
    over the same file's vocabulary; other vocabularies, and texts with a run of ``SPACES``
    white-space characters or more, go to the tokenizer library.
    """
    import json
    import re

    import numpy as np

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    library = common.tokenizer(path)

    def by_library(text):
        return np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    vocabulary, merges = made["model"]["vocab"], made["model"].get("merges", [])
    pairs = ("".join(m.split(" ")) if isinstance(m, str) else "".join(m) for m in merges)
    plain = made["pre_tokenizer"] == BYTE_LEVEL and made["normalizer"] is None
    if plain and all(vocabulary[p] == 256 + k for k, p in enumerate(pairs)):
        import tiktoken

        letters = _bytes_of_letters()
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): k
            for token, k in vocabulary.items()
            if token not in special
        }
        fast = tiktoken.Encoding(
            path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        long_run = re.compile(rf"(?<!\s)\s{{{SPACES}}}").search

        def ranked(text):
            if long_run(text):
                return by_library(text)
            return fast.encode_to_numpy(text, allowed_special="all")

        return ranked
    return by_library


@functools.cache
def sentence_ends(path: str):
    """For each id whether its text ends a sentence or a line."""
    import numpy as np

    tokenizer = common.tokenizer(path)
    ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
    for token, number in tokenizer.get_vocab().items():
        # byte-level vocabularies write the line feed as U+010A
        ends[number] = token.endswith((".", "!", "?", "Ċ"))
    return ends


def ends_of(ids, ends, capacity: int):
    """Where a window may end in a document, with the penalties; the last is its end."""
    import numpy as np

    inner = np.flatnonzero(ends[ids[:-1]]) + 1
    bounds = np.concatenate(([0], inner, [len(ids)]))
    gaps, stride = np.diff(bounds), min(STRIDE, capacity)
    places = [bounds[1:]]
    penalties = [np.full(len(bounds) - 1, SENTENCE)]
    for k in np.flatnonzero(gaps > stride):
        places.append(np.arange(bounds[k] + stride, bounds[k + 1], stride))
        penalties.append(np.full(len(places[-1]), BREAK))
    place, first = np.unique(np.concatenate(places), return_index=True)
    penalty = np.concatenate(penalties)[first]
    penalty[-1] = 0
    return place, penalty


def choose(places: list[int], penalties: list[int], capacity: int) -> list[int]:
    """The window ends of least cost over a stream that begins at 0 and ends at the last place.

    ``places`` increase by at most ``capacity``. Ties take the earlier end.
    """
    at = [0, *places]
    best = [0] * len(at)
    came = [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - capacity:
            queue.popleft()
        value, came[j] = queue[0]
        best[j] = value + penalties[j - 1] + capacity - here
        key = best[j] + here
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


class Packer:
    """Packs a task's documents as they come and gives the pieces of finished windows."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.sequence = capacity, first_id
        self.waiting: list[list] = []  # doc_id, ids, tokens already cut, places, penalties
        self.tokens = 0

    def add(self, doc_id, ids, place, penalty) -> None:
        self.waiting.append([doc_id, ids, 0, place, penalty])
        self.tokens += len(ids)

    def solve(self, last: bool) -> Iterator[tuple]:
        """Cut what waits; unless ``last``, only its first half (or one window at least)."""
        places, penalties, at = [], [], 0
        for _, ids, done, place, penalty in self.waiting:
            keep = place > done
            places += (place[keep] - done + at).tolist()
            penalties += penalty[keep].tolist()
            at += len(ids) - done
        if not places:
            return
        cuts = choose(places, penalties, self.capacity)
        if not last:
            cuts = [c for c in cuts if c <= at // 2] or cuts[:1]
        before = 0
        for cut in cuts:
            yield from self.window(cut - before)
            before = cut
        self.tokens -= before

    def window(self, size: int) -> Iterator[tuple]:
        offset, used = 0, 0
        for row in self.waiting:
            doc_id, ids, done, _, _ = row
            length = min(len(ids) - done, size - offset)
            piece = ids[done : done + length]
            data = piece.astype("<u4").tobytes()
            yield doc_id, done, length, len(ids), self.sequence, offset, data
            offset += length
            row[2] += length
            used += row[2] == len(ids)
            if offset == size:
                break
        del self.waiting[:used]
        self.sequence += 1


def pack(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of ``docs`` in packed sequences of at most ``capacity`` tokens.

    A row for each piece: ``doc_id``; ``start``, its document's tokens before it;
    ``length``; ``doc_tokens``; ``sequence_id``; ``offset`` in the sequence, without gaps;
    ``ids``, the tokens as little-endian unsigned 32-bit numbers. A document is its text's
    ids and ``end_id``. Each token is in exactly one piece.

    A null text is empty: one piece holding ``end_id``. A null or repeated ``doc_id`` is
    kept as it is, each row being a document of its own. Further columns, whatever their
    names, are ignored. An empty table gives an empty result.
    """
    path = vocabulary_path or common.vocabulary("byte_bpe_50k.json")

    def packed(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, ends = encoder(path), sentence_ends(path)
        end = np.array([end_id], dtype=np.uint32)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        types = [pa.int64()] * 6 + [pa.binary()]

        def batch(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
            )

        for rows in batches:
            texts = rows.column(1)
            for doc_id, text in zip(rows.column(0).to_pylist(), texts, strict=True):
                ids = np.concatenate((encode(text.as_py() or ""), end))
                packer.add(doc_id, ids, *ends_of(ids, ends, capacity))
                if packer.tokens >= BLOCK:
                    yield batch(packer.solve(last=False))
        yield batch(packer.solve(last=True))

    columns = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
    return columns.mapInArrow(packed, PIECES)
