"""Personal data against plain patterns, and pattern scores computed one by one."""

import re
from collections import defaultdict

import pytest

from retailflow.llm import personal_data as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text)
        if good(kind, m[0])
    )


def split(text):
    """(word or line end, start, end) of each."""
    return [(m[0], *m.span()) for m in re.finditer(r"\n|[^\s=:#]+[=:#]*|[=:#]+", text)]


def read(text):
    """Entities, candidates (with value and patterns) and the patterns of the other words."""
    words = split(text)
    found, spans = [], base(text)
    covered = set()

    def around(a, b):
        def key(k):
            word = words[k][0] if 0 <= k < len(words) else "\n"
            return word if word == "\n" else re.sub("[0-9]+", "0", word.lower())

        one = key(a - 1)
        return [("one", one), ("two", "\n" if one == "\n" else key(a - 2), one), ("side", one, key(b + 1))]

    for start, kind, end in spans:
        own = [k for k, (_, a, b) in enumerate(words) if a < end and b > start]
        found.append((start, kind, end, around(own[0], own[-1])))
        covered |= set(own)
    taken, k = set(covered), 0
    while k < len(words):
        first = k
        if re.search("[0-9]", words[k][0]):
            while (
                k + 1 < len(words)
                and text[words[k][2] : words[k + 1][1]] == " "
                and re.search("[0-9]", words[k + 1][0])
            ):
                k += 1
        elif "@" not in words[k][0]:
            k += 1
            continue
        whole = text[words[first][1] : words[k][2]]
        core = whole.strip("\"'`([{<>}]),.;:=#!?*|%$&")
        if len(core) >= 5 and (len(re.findall("[0-9]", core)) >= 3 or "@" in core[1:-1]):
            own = set(range(first, k + 1))
            if not own & taken:
                start = words[first][1] + whole.index(core)
                found.append((start, 4, start + len(core), around(first, k)))
                covered |= own
        k += 1
    others = [p for k, w in enumerate(words) if k not in covered and w[0] != "\n" for p in around(k, k)]
    return spans, found, others


def brute(rows, rounds=3, support=3, confident=500_000):
    held, others, seeds, texts = defaultdict(set), defaultdict(int), set(), []
    for doc_id, text in rows:
        text = text or ""
        spans, found, plain = read(text)
        valued = []
        for start, kind, end, patterns in found:
            value = re.sub(r"[\s-]+", "", text[start:end].lower())
            valued.append((start, kind, end, value))
            for p in patterns:
                held[p].add((value))
                if kind < 4:
                    seeds.add((p, value))
        for p in plain:
            others[p] += 1
        texts.append((doc_id, spans, valued))
    graph = {
        p: (v, len(v) + others[p] + 1)
        for p, v in held.items()
        if len(v) >= support and 10**6 * len(v) // (len(v) + others[p] + 1) >= confident
    }
    scores = {}
    for _ in range(rounds):
        found = {}
        for p, (values, size) in graph.items():
            total = sum(10**6 if (p, v) in seeds else scores.get(v, 0) for v in values)
            if total >= support * 10**6 and total // size >= confident:
                for v in values:
                    if (p, v) not in seeds:
                        found[v] = max(found.get(v, 0), total // size)
        scores = found
    result = []
    for doc_id, spans, valued in texts:
        added = [(s, k, e) for s, k, e, v in valued if k == 4 and v in scores]
        result.append(repr((doc_id, sorted(spans + added))))
    return sorted(result)


def rows(frame):
    return sorted(
        repr((r["doc_id"], [tuple(s)[:3] for s in r["spans"]])) for r in frame.select("doc_id", "spans").collect()
    )


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


CARDS = ["4111 1111 1111 1111", "5500-0000-0000-0004", "30569309025904", "378282246310005"]
ODD = [
    "a@b.c.d@e.f a@b@c.d @x.y x@y.", "x.y+z%_-@a-b.c-d..e f@g.h_i@j.k", "1.2.3.4.5.6.7.8 1.2.3 999.1.1.1",
    "000000255.0.0.256 0255.01.002.3 1.1.1.1", " ".join(CARDS), "1234567 8901234 4111111111111111-2",
    "+1 (017) 555-7713 +12 +1+4912345678901 +4 . . (555) 0123456)", "+1.2.3.4 12345678", "٣٤٥ +٣ a@ü.de é@x.y",
    "mailto:a@b.co,c@d.ef;(g@h.ij)", "192.168.0.1:8080 id=77812 #1234567 a=b=c", "9" * 30 + " " + "1-" * 40,
]


def test_entities_are_those_of_the_plain_patterns():
    import random

    rng = random.Random(7)
    texts = ODD + ["".join(rng.choices("a1@.+- (9", k=rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choices("0123456789- ", k=40)) for _ in range(500)]
    assert [t for t in texts if pii.entities(t) != base(t)] == []


def test_long_runs_take_linear_time():
    for part in ("a", "1", "1.", "a@", "+1 ", "1 ", "a.", "@", "+1" + " " * 500):
        text = part * (1_000_000 // len(part))
        pii.Text(text, pii.WordHashes())


def contexts():
    texts = [f"Passport no. {CARDS[k % 4]} was shown by guest {k}" for k in range(4)]
    texts += [f"Contact: user{k}@mail.org today" for k in range(4)] + ["Contact: u.n.known at once"]
    texts += ["Passport no. XK-9918273 was lost", "Later XK9918273 came back", "page 18273645 of the book"]
    texts += [f"the {card} one" for card in CARDS] + ["the 55512345 two", "the cat\n" * 9]
    texts += ["Contact: @some_one77", "badge XK-9918273 x", "badge QQ 123456 x", "badge 7-7-7-7-7 x"]
    return texts


def test_patterns_find_unseen_identifiers(spark):
    texts = contexts()
    found = {r["doc_id"]: r for r in pii.find_personal_data(table(spark, texts)).collect()}
    added = {
        (k, texts[k][s["start"] : s["end"]]) for k, r in found.items() for s in r["spans"] if s["kind"] == 4
    }
    assert {(9, "XK-9918273"), (10, "XK9918273")} <= added
    assert not {t for _, t in added} & {"18273645", "55512345"}
    assert rows(pii.find_personal_data(table(spark, texts))) == brute(list(enumerate(texts)))


def test_scores_spread_over_rounds(spark):
    texts = contexts() + [f"Member: ZZ{k}00{k} joined" for k in range(3)]
    texts += [f"Passport no. ZZ{k}00{k} again" for k in range(3)] + ["Member: 88-XY-221 joined"] * 2
    texts += [f"Passport no. {card} twice" for card in ("6011000990139424", "3530111333300000")]
    data = list(enumerate(texts))
    for rounds in (1, 2, 3):
        found = rows(pii.find_personal_data(table(spark, texts), rounds=rounds))
        assert found == brute(data, rounds)
    last = pii.find_personal_data(table(spark, texts)).filter("doc_id >= 27")
    assert last.count() > 0


def test_odd_and_long_texts(spark):
    texts = ODD + ["word " * 300_000 + "id 12345", "id: a@b.c\n" * 2000, None, "", " \n ", "\n", "x"]
    assert rows(pii.find_personal_data(table(spark, texts))) == brute(list(enumerate(texts)))


def test_slices_do_not_change_words(spark, monkeypatch):
    text = "one two\n\nthree=4 a@b.c  " * 200 + "y" * 500 + " end"
    hashes = pii.WordHashes()
    whole = pii.Text(text, hashes)
    monkeypatch.setattr(pii, "SLICE", 37)
    cut = pii.Text(text, hashes)
    assert (whole.words.hashes == cut.words.hashes).all() and whole.candidates == cut.candidates


def test_messy_rows(messy, messy_rows):
    wanted = brute([(r[0], r[1]) for r in messy_rows])
    assert rows(pii.find_personal_data(messy)) == wanted


def test_empty_table(nothing):
    assert pii.find_personal_data(nothing).count() == 0


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query(spark, size):
    import hashlib

    import __spark_entry__

    sf = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    wanted = []
    for line in brute([(d["doc_id"], d["text"]) for d in docs]):
        doc_id, spans = eval(line)
        text = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        own = [t for t in text if not t.startswith("identifier")]
        counts = [sum(t.startswith(f"{kind}:") for t in text) for kind in pii.KINDS]
        digest = hashlib.sha256(",".join(own).encode()).hexdigest()
        wanted.append((doc_id, *counts[:4], digest, ",".join(text), counts[4]))
    found = __spark_entry__.queries()["op13_personal_data"](spark, sf).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
