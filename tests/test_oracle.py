"""Every registered query against its SQL, and the driver contract."""

import functools

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from retailflow import oracle, queries

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def one_drain_per_topic():
    """Queries that read what one and the same stream leaves behind share its run here."""
    alone = queries._streamed, queries._run_totals
    queries._streamed, queries._run_totals = map(functools.cache, alone)
    yield
    queries._streamed, queries._run_totals = alone


def test_every_query_has_sql():
    assert set(oracle.SQL) == set(queries.QUERIES)


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query_equals_sql(spark, database, name):
    query = entry.queries()[name]
    assert compare.differences(spark, database, query, ORACLE[name], SF_DIR) == []


def test_entry(spark):
    (row,) = entry.entry(spark).collect()
    assert (row["orders"], row["total_quantity"], row["users"]) == (275, 7714, 132)
    assert str(row["total_revenue"]) == "402860594.79"
