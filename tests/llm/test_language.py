"""Language identification: segmentations by brute force, held-out accuracy, odd texts."""

import math
import zlib

import numpy as np

from retailflow.llm import language


def segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in segmentations(word[k:]):
            yield [word[:k], *rest]


def model():
    pieces = sorted([language.START, language.START + "a", "a", "b", "ab", "ba", "aba", "c"])
    rng = np.random.default_rng(1)
    return pieces, rng.random((len(pieces), 3)) / 10


def brute(word, pieces, probability, k):
    total = 0.0
    for parts in segmentations(language.START + word):
        p = 1.0
        for part in parts:
            if part in pieces:
                p *= probability[pieces.index(part), k]
            else:
                p *= language.STRANGE if len(part) == 1 and part not in pieces else 0
        total += p
    return total


def test_forward_sums_all_segmentations():
    pieces, probability = model()
    scorer = language.Scorer(pieces, probability)
    words = ["a", "abab", "abcaba", "xab", "", "bax"]
    made = scorer.lattice(words)
    found = made.forward(scorer.probability)[made.last]
    for word, row in zip(words, found, strict=True):
        for k in range(3):
            assert math.isclose(row[k], brute(word, pieces, probability, k), rel_tol=1e-9)
            long = language._long_word(scorer.automaton, scorer.strange, word, scorer.logs)
            assert math.isclose(math.exp(long[k]), row[k], rel_tol=1e-9)


def test_expected_pieces():
    pieces, probability = model()
    scorer = language.Scorer(pieces, probability)
    words, counts, langs = ["abab", "aba"], [3, 2], [1, 0]
    size = len(pieces) + 1
    made = scorer.lattice(words)
    found = made.expected(scorer.probability, np.array(langs), np.array(counts), size)
    wanted = np.zeros(3 * size)
    for word, n, k in zip(words, counts, langs, strict=True):
        total = brute(word, pieces, probability, k)
        for parts in segmentations(language.START + word):
            if all(p in pieces for p in parts):
                p = np.prod([probability[pieces.index(x), k] for x in parts])
                for part in parts:
                    wanted[k * size + pieces.index(part)] += n * p / total
    assert np.allclose(found, wanted[: len(found)])


def test_expected_pieces_of_long_words():
    pieces, probability = model()
    scorer = language.Scorer(pieces, probability)
    size = len(pieces) + 1
    for word in ("abab", "xab", "abcabaabba"):
        made = scorer.lattice([word])
        for k in range(3):
            wanted = made.expected(scorer.probability, np.array([k]), np.array([1]), size)
            found = language._long_expected(
                scorer.automaton, scorer.strange, word, scorer.logs[:, k]
            )
            assert np.allclose(found[: len(wanted) - k * size], wanted[k * size :])
            assert np.allclose(found[len(wanted) - k * size :], 0)


def test_long_words_teach(spark):
    """A language written without spaces is learned from its long words alone."""
    thai, lao = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอน", "ພາສາລາວເປັນພາສາທາງການຂອງສາທາລະນະລັດ"
    assert min(len(thai), len(lao)) > language.LONG
    rows = [(k, t, l) for k, (t, l) in enumerate([(thai, "th"), (lao, "lo")] * 5)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trained = language.train(labelled)
    texts = spark.createDataFrame([(1, thai[5:35]), (2, lao[5:35])], "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(texts, trained).collect()}
    assert found[1][0] == "th" and found[2][0] == "lo" and min(s for _, s in found.values()) > 0.9


def test_pieces_are_found_as_integers():
    """A number and a size in one integer: arcs are made without a tuple for each."""
    pieces, probability = model()
    scorer = language.Scorer(pieces, probability)
    found = [value for _, value in scorer.automaton.iter(language.START + "abac")]
    assert all(isinstance(value, int) for value in found)
    sizes = {(v >> language.SIZE_BITS, v & ((1 << language.SIZE_BITS) - 1)) for v in found}
    assert sizes == {(pieces.index(p), len(p)) for p in pieces if p in language.START + "abac"}


def test_pieces_keep_marks():
    from retailflow.llm import common

    pieces = language.read_pieces(common.vocabulary("piece_bpe_32k.model"))
    assert any(language._LETTERS(p) and not p.isalpha() for p in pieces)
    assert all(language._LETTERS(p.removeprefix(language.START)) for p in pieces if p != language.START)


def test_cache_reset_gives_the_same(monkeypatch):
    pieces, probability = model()
    texts = ["ab ba a", "c ab", "", "12", "aba ab abab " * 5, "ba" * 30]
    some, whole = language.Scorer(pieces, probability).texts(texts)
    assert some.tolist() == [True, True, False, False, True, True]
    monkeypatch.setattr(language, "CACHE", 2)
    small = language.Scorer(pieces, probability)
    for _ in range(2):
        for k, text in enumerate(texts):
            assert np.allclose(small.texts([text])[1][0], whole[k])


def test_query(spark, llm_tables):
    import __spark_entry__

    docs = spark.read.parquet(f"{llm_tables}/documents.parquet").select("doc_id", "lang").collect()
    lang = {d["doc_id"]: d["lang"] for d in docs}
    found = __spark_entry__.queries()["op6_language"](spark, llm_tables).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(lang)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_messy_rows(messy, messy_rows):
    trained = language.train_on_documents(messy)
    found = language.identify(messy, trained).collect()
    assert len(found) == len(messy_rows)
    blank = sum(not any(c.isalpha() for c in r[1] or "") for r in messy_rows)
    assert sum(r["lang_pred"] == "und" for r in found) == blank
    assert {r["lang_pred"] for r in found} <= {"en", "de", "und"}
    kept = language.keep_identified(messy, trained)
    clear = sum(r["score"] >= 0.55 for r in found)
    assert kept.columns == messy.columns and kept.count() == clear <= len(messy_rows) - blank


def test_letters_of_no_language_are_rejected(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en"), (2, "der Hund und die Katze", "de"),
         (3, "ⰀⰁⰂ ⰃⰄ ⰅⰆⰇ", None), (4, "the cat", None), (5, "12 !", None)],
        "doc_id long, text string, lang string",
    )
    trained = language.train(docs)
    kept = language.keep_identified(docs, trained).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 4]


def test_empty_table(nothing, messy):
    empty = language.train_on_documents(nothing)
    assert empty["languages"] == []
    assert language.identify(nothing, empty).count() == 0
    assert {r["lang_pred"] for r in language.identify(messy, empty).collect()} == {"und"}
