"""Quality rules against lines and windows counted one by one."""

import re
from collections import Counter, defaultdict

from retailflow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def numbers(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def brute(rows, share=0.0, least=quality.LEAST):
    """rows: doc_id, text, host."""
    def key(line):
        return tuple(WORD.findall(re.sub("[0-9]", "0", line.lower())))

    texts, held = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if key(line):
                held[host, key(line)].add(text)
    found = []
    for doc_id, text, host in rows:
        n, *rest = numbers(text or "")
        size = len(texts[host])

        def boilerplate(n, size=size):
            if n > least and n > share * size:
                return True
            return size <= least and n >= quality.SMALL_LEAST and n > quality.SMALL_SHARE * size

        gone = sum(
            len(key(x))
            for x in (text or "").split("\n")
            if key(x) and boilerplate(len(held[host, key(x)]))
        )
        failed = n < 20 or 100 * rest[-1] > 30 * n
        found.append(str((doc_id, n, *rest, failed, not failed and n - gone >= 0.5 * n, gone)))
    return sorted(found)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COLUMNS += ["base_failed", "kept", "words_removed"]


def rows(frame):
    return sorted(str(tuple(r)) for r in frame.select(*COLUMNS).collect())


def test_messy_rows(messy, messy_rows):
    data = [(r[0], r[1], r[3]) for r in messy_rows]
    assert rows(quality.assess(messy)) == brute(data)
    assert rows(quality.assess(messy, share=0.0, least=1)) == brute(data, 0.0, 1)


def test_boilerplate(spark):
    common = "Menu 12 home contact about all of this site and more to come"
    data = []
    for k in range(60):
        own = " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j % 26)}{j}" for j in range(30))
        data.append((k, f"{common.replace('12', str(k))}\n{own}", "a" if k < 40 else "b"))
    data += [(100 + k, f"{common}\nonly a few more words of my own {k} here", "a") for k in range(5)]
    data += [(200 + k, f"{common} copied\n" + "copy " * 3, "b") for k in range(50)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = quality.assess(docs)
    assert rows(found) == brute(data)
    kept = {r["doc_id"] for r in found.filter("kept").collect()}
    assert set(range(60)) <= kept and not kept & set(range(100, 105))


def removed(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    return {r["doc_id"]: r["words_removed"] for r in quality.assess(docs).collect()}


def own_words(k):
    return " ".join(f"own{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}" for j in range(25))


def test_line_in_few_percent_of_a_large_host(spark):
    line = "Read more about this site here"
    data = [(k, (f"{line}\n" if k < 30 else "") + own_words(k), "large") for k in range(400)]
    data += [(400 + k, "Seen in twenty\n" + own_words(400 + k), "large") for k in range(20)]
    assert removed(spark, data) == {k: 6 if k < 30 else 0 for k in range(420)}


def test_small_hosts(spark):
    line = "Home contact about"
    data, wanted = [], {}
    for size in (2, 3, 4, 20):
        for holding in {2, size // 2, size // 2 + 1, size}:
            for k in range(size):
                i, host = len(data), f"{size} {holding}"
                data.append((i, (f"{line} {k % 10}\n" if k < holding else "") + own_words(i), host))
                wanted[i] = 4 if k < holding and holding >= 3 and 2 * holding > size else 0
    assert {0, 4} == set(wanted.values())
    data += [(len(data) + k, f"{line}\n" + own_words(0), "copies") for k in range(15)]
    assert removed(spark, data) == wanted | {k: 0 for k in range(len(wanted), len(data))}
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    assert rows(quality.assess(docs)) == brute(data)


def test_repeated_windows(spark):
    import random

    rng = random.Random(4)
    texts = [" ".join(rng.choices("ab", k=rng.randrange(0, 60))) for _ in range(150)]
    phrase = "one two three four five six seven eight nine"
    texts += [f"{phrase} {phrase}", f"{phrase} x {phrase} y z " + phrase[:30], "q " * 500]
    data = [(k, t, "s") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    assert rows(quality.assess(docs)) == brute(data)


def test_query(spark, small_documents):
    import __spark_entry__

    found = __spark_entry__.queries()["op9_quality"](spark, "/root/testdata/sf0.001")
    assert rows(found) == brute([(d["doc_id"], d["text"], d["source"]) for d in small_documents])


def test_empty_table(nothing):
    assert quality.assess(nothing).count() == 0
