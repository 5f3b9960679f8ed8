"""Tables of the session catalog: created once, published folders only, views as reports read."""

import pytest
from conftest import NOW
from samples import found, order, raw

from retailflow.catalog import Catalog
from retailflow.plans import scheduled
from retailflow.plans.archive import archive_transactions
from retailflow.streaming import jobs
from retailflow.tables import GATHERED, TRANSACTION_COLUMNS

VIEWS = [
    "transaction_data", "clickstream_logs", "inventory_updates", "batch_details", "sales_by_payment",
    "sales_by_shipping",
]


@pytest.fixture
def catalog(spark, tables):
    made = Catalog(tables, "shop")
    made.create()
    yield made
    spark.sql("DROP DATABASE shop CASCADE")


def ingest(tables, *changes):
    rows = raw(tables.spark, [order(**change) for change in changes])
    return jobs.ingest(tables, "transactions", rows, lambda: NOW)


def agree(catalog):
    catalog.refresh()
    for view in VIEWS:
        own = catalog.tables.read(view)
        stored = catalog.spark.sql(f"SELECT * FROM shop.{view}")
        assert sorted(stored.columns) == sorted(own.columns)
        assert found(stored, *own.columns) == found(own), view


def test_created_twice(catalog):
    before = found(catalog.describe())
    catalog.create()
    assert found(catalog.describe()) == before
    assert catalog.exists("transactions_log") and not catalog.exists("orders")
    partitions = {r["column"] for r in catalog.describe().filter("table = 'transactions_log' AND partition").collect()}
    assert partitions == {"batch_id", "status", "event_date"}


def test_views_follow_batches_gathering_and_the_archive(catalog):
    tables = catalog.tables
    agree(catalog)
    old = "2023-01-01T00:00:00+00:00"
    ingest(tables, {}, {"order_id": "o2", "timestamp": old}, {"price": None})
    agree(catalog)
    for name in GATHERED:
        tables.gather(name)
    agree(catalog)
    ingest(tables, {"order_id": "o3"}, {"order_id": "o4", "timestamp": old})
    agree(catalog)
    archive_transactions(tables, NOW)
    agree(catalog)
    ingest(tables, {"order_id": "late", "timestamp": old})
    for name in GATHERED:
        tables.gather(name)
    agree(catalog)
    archive_transactions(tables, NOW)  # drops the folders the first run archived
    agree(catalog)
    assert found(catalog.spark.sql("SELECT order_id FROM shop.transaction_data")) == [("o1",), ("o3",)]


def test_unpublished_batches_are_not_registered(catalog):
    tables = catalog.tables
    ingest(tables, {})
    parsed = jobs.parse_events(raw(tables.spark, [order(quantity=9)]), "transactions")
    jobs.write_log(tables, "transactions", parsed, 1, NOW)
    jobs.derive_tables(tables, 1, NOW)
    agree(catalog)
    names = ", ".join(TRANSACTION_COLUMNS)
    assert catalog.spark.sql(f"SELECT {names} FROM shop.transaction_data").count() == 1


def test_counts(catalog):
    ingest(catalog.tables, {}, {"user_id": "u2"})
    catalog.tables.gather("transactions_log")
    ingest(catalog.tables, {})
    catalog.refresh()
    counts = dict(found(catalog.counts()))
    assert (counts["transactions_log"], counts["user_changes"], counts["alerts"]) == (3, 3, 0)


def test_coordinates_are_loaded_once(spark, tables, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("city,state,latitude,longitude\nAustin,TX,30.25,-97.75\n")
    catalog = Catalog(tables, "gate")
    assert scheduled.load_coordinates_once(catalog, str(path)) == 1
    assert scheduled.load_coordinates_once(catalog, str(path)) == 0
    spark.sql("DROP DATABASE gate CASCADE")
    assert scheduled.load_coordinates_once(Catalog(tables, "other"), str(path)) == 0
