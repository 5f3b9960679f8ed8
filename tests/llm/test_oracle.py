"""The queries that have SQL against it."""

import compare
import duckdb
import pytest
from llm.conftest import messy_texts

import __spark_entry__ as entry
from retailflow.llm import oracle, queries


def test_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(oracle.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query_equals_sql(spark, llm_tables, name):
    database = compare.connect(llm_tables)
    query = entry.queries()[name]
    assert compare.differences(spark, database, query, entry.oracle_sql()[name], llm_tables) == []


@pytest.mark.parametrize("name", ["op8_licenses", "op9_quality", "op10_secrets"])
def test_query_equals_sql_on_a_larger_table(spark, name):
    """Hosts of over 200 documents: here rules that depend on size would part."""
    folder = "/root/testdata/sf0.1"
    database = compare.connect(folder)
    query = entry.queries()[name]
    assert compare.differences(spark, database, query, entry.oracle_sql()[name], folder) == []


def test_sql_of_odd_tables(spark, tmp_path):
    """Wrapped notices, small hosts and tokens of two owners, messy texts: queries against SQL."""
    notice = (
        "Redistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions are met:"
    )
    token = "aB3" * 14
    texts = [t for t in messy_texts() if t is None or len(t) < 50_000] + [notice, f"# {notice}"]
    rows = [(k, t, None, "large", 1) for k, t in enumerate(texts)]
    for host in range(6):
        for k in range(host + 1):
            own = " ".join(f"w{host}{k}{j}" for j in range(25))
            rows.append((len(rows), f"Home contact {k}\n{own} {token if host == 4 else ''}", None, f"h{host}", 1))
    rows.append((len(rows), f"x {token}", None, "other", 1))
    path = str(tmp_path)
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).coalesce(1).write.parquet(f"{path}/table")
    (part,) = (tmp_path / "table").glob("*.parquet")
    part.rename(tmp_path / "documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    for name in ("op8_licenses", "op9_quality", "op10_secrets", "op12_fill_in_middle"):
        query, sql = entry.queries()[name], entry.oracle_sql()[name]
        assert compare.differences(spark, database, query, sql, path) == [], name
