"""Secret scans against Python's regular expressions."""

import hashlib
import re
from collections import defaultdict

from retailflow.llm import secrets

ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base(text):
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [
        (m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20
    ]
    return found + [
        (m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24
    ]


def mixed(text):
    return [
        (m.start(), 3, m.end(), m[0])
        for m in re.finditer(r"[A-Za-z0-9+/_-]+", text)
        if len(m[0]) >= 32 and all(re.search(p, m[0]) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    ]


def join(spans):
    names = list(secrets.KINDS)
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in sorted(spans))


def brute(rows):
    """rows: doc_id, text, owner."""
    owners = defaultdict(set)
    for _, text, owner in rows:
        for *_, value in base(text or "") + mixed(text or ""):
            owners[value].add(owner)
    found = []
    for doc_id, text, _ in rows:
        of_base = base(text or "")
        spans = of_base + [s for s in mixed(text or "") if len(owners[s[3]]) < secrets.WIDE]
        kinds = [s[1] for s in of_base]
        live = sum(len(owners[s[3]]) < secrets.WIDE for s in spans)
        digest = hashlib.sha256(join(of_base).encode()).hexdigest()
        counts = (kinds.count(0), kinds.count(1), kinds.count(2))
        found.append(str((doc_id, *counts, digest, join(spans), live, len(spans) - live)))
    return sorted(found)


def query(spark, folder):
    import __spark_entry__

    return sorted(str(tuple(r)) for r in __spark_entry__.queries()["op10_secrets"](spark, folder).collect())


def test_messy_rows(spark, messy, messy_rows, tmp_path):
    messy.write.parquet(str(tmp_path / "documents.parquet"))
    assert query(spark, str(tmp_path)) == brute([(r[0], r[1], r[3]) for r in messy_rows])


def test_widely_copied_values(spark):
    data = [(k, "token=abcdefgh " + f"secret: own{k}value {k}", f"o{k % 4}") for k in range(12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = secrets.find_secrets(docs).collect()
    assert {(r["n_assign"], r["n_live"], r["n_example"]) for r in found} == {(2, 1, 1)}
    (spans,) = {tuple((s["owners"], s["repositories"]) for s in r["spans"]) for r in found}
    assert spans == ((4, 12), (1, 1))


def test_mixed_token_of_two_owners(spark):
    tokens = [f"Ab{k}" * 12 for k in range(1, 5)]
    data = [
        (owner, f"see {token}", f"o{owner}")
        for k, token in enumerate(tokens, 1)
        for owner in range(k)
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = [s["owners"] for r in secrets.find_secrets(docs).collect() for s in r["spans"]]
    assert sorted(found) == [1, 2, 2]


def test_query(spark, small_documents):
    rows = [(d["doc_id"], d["text"], d["source"]) for d in small_documents]
    assert query(spark, "/root/testdata/sf0.001") == brute(rows)


def test_empty_table(nothing):
    assert secrets.find_secrets(nothing).count() == 0
