"""Language identification by segmentation-marginalised unigrams (operator 6).

A language is a probability for each piece of a fixed public vocabulary. The probability of a
word is the sum over all its segmentations into pieces, by a forward pass; that of a text is
the product over its words, its runs of letters in lower case. Pieces never reach over a word's
end, so a word is scored once and its score is kept.

The probabilities come from expectation maximisation on labelled rows: every round sums, over
the counted words of each language, how often each piece is expected in a random segmentation.
The rows may be a random sample of about ``SAMPLE`` per language, the one bound here. Counting
and expectation run on the executors; the driver gets one number per language and piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retailflow.llm import common
from retailflow.llm.common import stored

#: Labelled rows of a language that are learned from, on average; None for all.
SAMPLE = 4000
ROUNDS = 3
UNKNOWN = "und"
#: Added to every expected count, so that no piece is impossible in any language.
SMOOTH = 0.05
#: Probability of a character outside the vocabulary, the same in all languages.
STRANGE = 1e-7
#: Longer words are summed in logarithms, one by one.
LONG = 24
#: Words whose scores a worker keeps, and characters it scores at a time.
CACHE, SLICE = 250_000, 1 << 20
#: Words whose segmentations are in memory at a time when scoring.
LATTICE = 4000
#: A piece's number and size are one integer, with so many bits for the size.
SIZE_BITS = 16
START = "▁"


def read_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters and marks, with the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {
        model.id_to_piece(k)
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))
    }
    kept = {p for p in pieces if _LETTERS(p.removeprefix(START)) and p == p.lower()}
    return sorted(kept | {START})


def words_of(text: str) -> list[str]:
    """Runs of letters and marks that begin with a letter, in lower case."""
    return _WORDS(text.lower())


def _find():
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def _letters():
    import regex

    return regex.compile(r"[\p{L}\p{M}]+").fullmatch


_WORDS, _LETTERS = _find(), _letters()


class Lattice:
    """All segmentations of a batch of words, as arcs between the places of their characters.

    Places run through the batch: word w with n characters (its start mark being one) has
    n + 1 of them from ``first[w]`` on.
    """

    def __init__(self, automaton, strange: int, words: list[str]):
        import numpy as np

        marked = [START + w for w in words]
        lengths = np.array([len(w) for w in marked])
        self.first = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        self.last = self.first + lengths
        self.places = int(self.last[-1]) + 1
        # A line feed ends each word: no piece holds one.
        found = chain.from_iterable(automaton.iter("\n".join(marked)))
        ends, values = np.fromiter(found, np.int64).reshape(-1, 2).T
        pieces, sizes = values >> SIZE_BITS, values & ((1 << SIZE_BITS) - 1)
        covered = np.zeros(self.places, dtype=bool)
        covered[ends[sizes == 1]] = True
        covered[self.last] = True
        bare = np.flatnonzero(~covered)
        ends = np.concatenate((ends, bare)) + 1
        pieces = np.concatenate((pieces, np.full(len(bare), strange)))
        sizes = np.concatenate((sizes, np.ones(len(bare), dtype=np.int64)))
        offset = ends - np.repeat(self.first, lengths + 1)[ends]
        order = np.lexsort((ends, offset))
        self.ends, self.pieces = ends[order], pieces[order]
        self.starts = self.ends - sizes[order]
        self.steps = np.searchsorted(offset[order], np.arange(1, lengths.max() + 2))

    def forward(self, probability):
        """Per place and language the summed probability of all ways from the word's start."""
        import numpy as np

        alpha = np.zeros((self.places, probability.shape[1]))
        alpha[self.first] = 1
        weights = probability[self.pieces]
        for a, b in zip(self.steps[:-1], self.steps[1:], strict=True):
            ends = self.ends[a:b]
            groups = np.flatnonzero(np.diff(ends, prepend=-1))
            ways = alpha[self.starts[a:b]] * weights[a:b]
            alpha[ends[groups]] = np.add.reduceat(ways, groups)
        return alpha

    def expected(self, probability, language, counts, size: int):
        """Expected pieces per language, each word counting for its own language only."""
        import numpy as np

        lengths = self.last - self.first + 1
        own = np.repeat(language, lengths)
        alpha = self.forward(probability)[np.arange(self.places), own]
        beta = np.zeros(self.places)
        total = alpha[self.last]
        beta[self.last] = np.where(total > 0, counts / np.where(total > 0, total, 1), 0)
        weights = probability[self.pieces, own[self.ends]]
        flow = np.zeros(len(weights))
        for a, b in zip(self.steps[-2::-1], self.steps[:0:-1], strict=True):
            ways = weights[a:b] * beta[self.ends[a:b]]
            np.add.at(beta, self.starts[a:b], ways)
            flow[a:b] = alpha[self.starts[a:b]] * ways
        return np.bincount(own[self.ends] * size + self.pieces, weights=flow)


def _long_arcs(automaton, strange: int, word: str) -> list[tuple]:
    """For each place of one word behind its start, where the pieces that end there begin, and
    which they are, as arrays."""
    import numpy as np

    marked = START + word
    arcs: list[list[tuple[int, int]]] = [[] for _ in range(len(marked) + 1)]
    for end, value in automaton.iter(marked):
        piece, size = value >> SIZE_BITS, value & ((1 << SIZE_BITS) - 1)
        arcs[end + 1].append((end + 1 - size, piece))
    made = []
    for end in range(1, len(arcs)):
        ways = arcs[end]
        if not any(end - start == 1 for start, _ in ways):
            ways = [*ways, (end - 1, strange)]
        made.append(tuple(np.array(ways).T))
    return made


def _long_forward(arcs: list[tuple], logs):
    """The forward pass of one long word in logarithms, a row for each place."""
    import numpy as np

    alpha = np.full((len(arcs) + 1, logs.shape[1]), -np.inf)
    alpha[0] = 0
    for end, (starts, pieces) in enumerate(arcs, 1):
        alpha[end] = np.logaddexp.reduce(alpha[starts] + logs[pieces], axis=0)
    return alpha


def _long_word(automaton, strange: int, word: str, logs):
    return _long_forward(_long_arcs(automaton, strange, word), logs)[-1]


def _long_expected(automaton, strange: int, word: str, logs):
    """Expected pieces in a random segmentation of one long word, by one language's ``logs``."""
    import numpy as np

    arcs = _long_arcs(automaton, strange, word)
    alpha = _long_forward(arcs, logs[:, None])[:, 0]
    beta = np.full(len(alpha), -np.inf)
    beta[-1] = 0
    found = np.zeros(len(logs))
    for end in range(len(arcs), 0, -1):
        starts, pieces = arcs[end - 1]
        ways = logs[pieces] + beta[end]
        # The starts of the pieces that end at one place differ.
        beta[starts] = np.logaddexp(beta[starts], ways)
        found[pieces] += np.exp(alpha[starts] + ways - alpha[-1])
    return found


class Scorer:
    """Log-probabilities of words in every language, kept for words that come again."""

    def __init__(self, pieces: list[str], probability):
        import ahocorasick
        import numpy as np

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, piece in enumerate(pieces):
            self.automaton.add_word(piece, k << SIZE_BITS | len(piece))
        self.automaton.make_automaton()
        self.strange = len(pieces)
        bare = np.full((1, probability.shape[1]), STRANGE)
        self.probability = np.vstack((probability, bare))
        self.logs = np.log(self.probability)
        self.cache: dict[str, int] = {}
        self.known = np.zeros((0, probability.shape[1]))

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self.automaton, self.strange, words)

    def learn(self, words: set[str]) -> None:
        import numpy as np

        if len(self.cache) + len(words) > CACHE:
            self.cache, self.known = {}, self.known[:0]
        short = [w for w in words if len(w) <= LONG]
        long = [w for w in words if len(w) > LONG]
        rows = [self.known]
        for k in range(0, len(short), LATTICE):
            part = short[k : k + LATTICE]
            made = self.lattice(part)
            rows.append(np.log(made.forward(self.probability)[made.last]))
        rows += [_long_word(self.automaton, self.strange, w, self.logs)[None] for w in long]
        self.cache.update(zip(short + long, range(len(self.known), 1 << 60), strict=False))
        self.known = np.vstack(rows)

    def texts(self, texts: list[str]):
        """(has a letter, log-probability per language) of each text."""
        import numpy as np

        found = [words_of(t) for t in texts]
        every = [w for words in found for w in words]
        distinct = set(every)
        if not distinct <= self.cache.keys():
            new = distinct - self.cache.keys()
            # A reset drops what this slice needs, so it learns all of its words then.
            self.learn(distinct if len(self.cache) + len(new) > CACHE else new)
        sizes = np.array([len(words) for words in found])
        total = np.zeros((len(texts), self.known.shape[1]))
        if every:
            index = np.fromiter(map(self.cache.__getitem__, every), np.int64, len(every))
            some = np.flatnonzero(sizes)
            at = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
            total[some] = np.add.reduceat(self.known[index], at)
        return sizes > 0, total


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= SLICE:
            yield part
            part, size = [], 0
    yield part


def _sampled(labelled: DataFrame, sample: int | None) -> tuple[DataFrame, list[str]]:
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["lang"]: r["n"] for r in sizes.collect()}
    if sample and counts:
        share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, sample / n)])
        place = (F.xxhash64("doc_id", "text") / F.lit(2.0**64)) + 0.5
        labelled = labelled.filter(place < F.element_at(share, F.col("lang")))
    return labelled, sorted(counts)


def train(
    labelled: DataFrame,
    vocabulary_path: str | None = None,
    sample: int | None = SAMPLE,
    rounds: int = ROUNDS,
) -> dict:
    """A model from rows with ``text`` and ``lang``; rows without either teach nothing.

    ``sample`` bounds, by the hash of doc_id and text, how many rows of each language are
    used, on average. Without any labelled row the model knows no language.
    """
    import numpy as np

    pieces = read_pieces(vocabulary_path or common.vocabulary("piece_bpe_32k.model"))
    rows = labelled.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    rows, languages = _sampled(rows, sample)
    size = len(pieces) + 1
    probability = np.full((len(pieces), len(languages)), 1.0 / size)
    if not languages:
        return {"pieces": pieces, "languages": [], "probability": probability}

    def count(batches):
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for word in words_of(text.as_py()):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "word", "n"],
            )

    words = (
        rows.select("text", "lang")
        .mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    words = stored(words, "language-words")
    number = {lang: k for k, lang in enumerate(languages)}
    for _ in range(rounds):
        current = probability

        def expect(batches, current=current):
            scorer = Scorer(pieces, current)
            total = np.zeros(len(languages) * size)
            for batch in batches:
                langs = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
                texts, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                if not len(texts):
                    continue
                for lang, word, n in zip(langs, texts, counts, strict=True):
                    if len(word) > LONG:
                        found = _long_expected(
                            scorer.automaton, scorer.strange, word, scorer.logs[:, lang]
                        )
                        total[lang * size : (lang + 1) * size] += n * found
                short = [k for k, word in enumerate(texts) if len(word) <= LONG]
                if not short:
                    continue
                made = scorer.lattice([texts[k] for k in short])
                found = made.expected(scorer.probability, langs[short], counts[short], size)
                total[: len(found)] += found
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(total[at])], names=["at", "n"]
            )

        sums = words.mapInArrow(expect, "at long, n double")
        sums = sums.groupBy("at").agg(F.sum("n").alias("n"))
        # At most one row per language and piece: the vocabulary bounds it.
        total = np.zeros(len(languages) * size)
        for row in sums.collect():
            total[row["at"]] = row["n"]
        expected = total.reshape(len(languages), size)[:, :-1].T + SMOOTH
        probability = expected / expected.sum(axis=0)
        # A word's start by itself tells no language, so strange letters after it tell none.
        probability[pieces.index(START)] = probability[pieces.index(START)].mean()
    return {"pieces": pieces, "languages": languages, "probability": probability}


def predicted(text: Column, model: dict) -> Column:
    """A struct of ``lang`` and ``score``, the posterior of the language under equal priors.

    ``und`` with score 0 for null texts, texts without a letter, and a model of no language.
    """
    @F.arrow_udf("struct<lang:string,score:double>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        languages = model["languages"]
        scorer = Scorer(model["pieces"], model["probability"])
        for texts in batches:
            names, scores = [], []
            for part in _slices(texts) if languages else ():
                some, logs = scorer.texts(part)
                best = logs.argmax(axis=1) if len(part) else []
                for k in range(len(part)):
                    names.append(languages[best[k]] if some[k] else UNKNOWN)
                    scores.append(1 / np.exp(logs[k] - logs[k][best[k]]).sum() if some[k] else 0.0)
            if not languages:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    # Not to be repeated where a filter uses it.
    return made.asNondeterministic()(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    """Whether the row may only be predicted; a null doc_id is never learned from either."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``.

    Each row is judged by its text alone. Null or repeated doc_ids are kept, further columns
    are ignored, and an empty table gives an empty result.
    """
    return (
        docs.select("doc_id", "text")
        .withColumn("found", predicted(F.col("text"), model))
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            held_out(F.col("doc_id")).alias("held_out"),
            F.col("found.lang").alias("lang_pred"),
            F.col("found.score").alias("score"),
        )
    )


def train_on_documents(docs: DataFrame, **options) -> dict:
    """A model from the rows that are not held out."""
    return train(docs.filter(~held_out(F.col("doc_id"))), **options)


#: How much more than an even chance the predicted language of a kept text must have.
BETTER = 1.1


def keep_identified(docs: DataFrame, model: dict, better: float = BETTER) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and likelier than by chance alone.

    Texts all of whose letters are outside the vocabulary are as likely in every language.
    """
    least = min(1.0, better / max(1, len(model["languages"])))
    found = predicted(F.col("text"), model)
    return (
        docs.select(F.struct("*").alias("doc"), found.alias("found"))
        .filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least))
        .select("doc.*")
    )
