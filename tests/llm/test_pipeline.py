"""The pipeline against the brute-force versions of its stages, one after the other."""

import os

import corpus_pipeline
from llm import test_decontamination, test_line_dedup, test_packing, test_simhash
from retailflow.llm import line_dedup


def brute(rows, items, min_words=line_dedup.MIN_WORDS):
    """rows: doc_id, text in a known language, by doc_id. The texts that reach packing."""
    left = []
    for (doc_id, text), gone in zip(rows, test_line_dedup.brute(rows, min_words), strict=True):
        new = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        if not gone or new.strip(test_line_dedup.SPACE):
            left.append((doc_id, new if gone else text))
    classes = test_simhash.brute_classes([test_simhash.brute_print(t) for _, t in left], 2)
    first = {}
    for (doc_id, text), c in zip(left, classes, strict=True):
        first.setdefault(c, (doc_id, text))
    kept = []
    for doc in first.values():
        (found,) = test_decontamination.brute([doc], items)
        if found.endswith("False)"):
            kept.append(doc)
    return dict(kept)


def letters(text):
    return any(c.isalpha() for c in text or "")


def test_run_equals_the_stages_by_brute_force(spark, small_documents):
    tables = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted((d["doc_id"], d["text"]) for d in small_documents if letters(d["text"]))
    wanted = brute(rows, items)
    found = corpus_pipeline.run(spark, tables).collect()
    assert {r["doc_id"] for r in found} == set(wanted) and 0 < len(wanted) < len(rows)
    test_packing.checked(found, wanted, 2048)
    shared = f"{spark.conf.get('spark.checkpoint.dir')}/retailflow"
    stages = [p for p in os.listdir(shared) if p.startswith("pipeline-")]
    assert {p.split("-")[1] for p in stages} == {"packing"}  # the others' rows are deleted


def test_every_stage_but_the_last_keeps_the_columns(spark, messy, tmp_path):
    messy.write.parquet(str(tmp_path / "documents.parquet"))
    texts = [(1, "some test item that nobody has " * 2), (None, None)]
    spark.createDataFrame(texts, "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    docs = messy
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(str(tmp_path / f"stage{k}"))
        read = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert read.columns == messy.columns and 0 < read.count() <= docs.count()
        docs = read
    assert {"doc_id", "sequence_id", "ids"} <= set(docs.columns)


def test_stages_of_an_empty_table(spark, nothing, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0
