"""The archive move: conservation, repetition, late rows, deletion."""

from datetime import datetime, timedelta

import pytest
from conftest import NOW
from samples import found, order, raw

from retailflow import files
from retailflow.plans.archive import archive_transactions
from retailflow.schemas import columns
from retailflow.streaming import jobs

CUTOFF = NOW - timedelta(days=30)


def stamp(time):
    return time.isoformat() + "+00:00"


def ingest(tables, *changes):
    rows = raw(tables.spark, [order(**change) for change in changes])
    return jobs.ingest(tables, "transactions", rows, lambda: NOW)


def ids(tables, name):
    return [row[0] for row in found(tables.read(name), "order_id")]


def test_rows_before_the_cutoff_move(tables):
    ingest(
        tables,
        {"order_id": "old", "timestamp": stamp(CUTOFF - timedelta(microseconds=1))},
        {"order_id": "at", "timestamp": stamp(CUTOFF)},
        {"order_id": "new", "timestamp": stamp(NOW)},
        {"order_id": "older", "timestamp": "2023-01-01T00:00:00+00:00", "user_id": "u2"},
    )
    assert archive_transactions(tables, NOW) == 0
    assert ids(tables, "archived_transaction_data") == ["old", "older"]
    assert ids(tables, "transaction_data") == ["at", "new"]
    moved = tables.read("archived_transaction_data")
    assert moved.columns[: len(columns("transactions"))] == columns("transactions")
    assert moved.filter("user_name IS NULL OR user_email IS NULL").count() == 0


def test_rows_keep_the_names_they_were_logged_with(tables):
    old = "2023-01-01T00:00:00+00:00"
    ingest(tables, {"user_name": "Maiden", "timestamp": old})
    ingest(tables, {"user_name": "Married", "order_id": "o2"})
    archive_transactions(tables, NOW)
    assert found(tables.read("archived_transaction_data"), "user_name") == [("Maiden",)]


def test_folders_of_gathered_batches_are_dropped(tables):
    log = tables.path("transactions_log") + "_gathered/status=accepted/event_date=*/through=*"
    ingest(tables, {"order_id": "a", "timestamp": "2023-01-01T00:00:00+00:00"})
    ingest(tables, {"order_id": "b"})
    tables.gather("transactions_log")
    archive_transactions(tables, NOW)
    assert ids(tables, "transaction_data") == ["b"]
    assert len(files.matches(tables.spark, log)) == 2
    ingest(tables, {"order_id": "late", "timestamp": "2023-01-01T00:00:00+00:00"})
    archive_transactions(tables, NOW)
    assert len(files.matches(tables.spark, log)) == 1
    tables.gather("transactions_log")
    assert ids(tables, "transaction_data") == ["b"]
    assert ids(tables, "archived_transaction_data") == ["a", "late"]


def test_late_rows_stay_live_until_the_next_run(tables):
    old = "2023-01-01T00:00:00+00:00"
    ingest(tables, {"order_id": "a", "timestamp": old})
    archive_transactions(tables, NOW)
    ingest(tables, {"order_id": "late", "timestamp": old})
    assert ids(tables, "transaction_data") == ["late"]
    archive_transactions(tables, NOW)
    assert ids(tables, "transaction_data") == []
    assert ids(tables, "archived_transaction_data") == ["a", "late"]


def test_folders_are_dropped_one_run_later(tables):
    log = tables.batch_path("transactions_log", 0) + "/status=accepted/event_date=*"
    ingest(
        tables,
        {"order_id": "a", "timestamp": "2023-01-01T00:00:00+00:00"},
        {"order_id": "b", "timestamp": stamp(CUTOFF - timedelta(hours=1))},
        {"order_id": "c", "timestamp": stamp(CUTOFF + timedelta(hours=1))},
    )
    archive_transactions(tables, NOW)
    assert len(files.matches(tables.spark, log)) == 2
    archive_transactions(tables, NOW)
    assert len(files.matches(tables.spark, log)) == 1
    assert ids(tables, "transaction_data") == ["c"]
    archive_transactions(tables, NOW + timedelta(days=1))
    archive_transactions(tables, NOW + timedelta(days=1))
    assert files.matches(tables.spark, log) == []
    assert ids(tables, "archived_transaction_data") == ["a", "b", "c"]
    assert ids(tables, "transaction_data") == []


def test_a_failed_run_is_repeated(tables, monkeypatch):
    ingest(tables, {"timestamp": "2023-01-01T00:00:00+00:00"}, {"order_id": "new"})

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(type(tables), "commit", fail)
        with pytest.raises(OSError):
            archive_transactions(tables, NOW)
    assert ids(tables, "archived_transaction_data") == []
    assert ids(tables, "transaction_data") == ["new", "o1"]
    assert archive_transactions(tables, NOW) == 0
    assert ids(tables, "archived_transaction_data") == ["o1"]
    assert ids(tables, "transaction_data") == ["new"]


def test_time_does_not_go_back(tables):
    ingest(tables, {})
    archive_transactions(tables, NOW)
    with pytest.raises(ValueError):
        archive_transactions(tables, NOW - timedelta(days=1))


def test_retention_is_an_argument(tables):
    ingest(tables, {"timestamp": stamp(NOW - timedelta(days=2))})
    archive_transactions(tables, NOW, retention=timedelta(days=1))
    assert ids(tables, "archived_transaction_data") == ["o1"]
    assert tables.archive_run() == (NOW - timedelta(days=1), 0)
    assert isinstance(tables.archive_run()[0], datetime)


def test_archived_folders_are_not_opened(tables):
    ingest(tables, {"timestamp": "2023-01-01T00:00:00+00:00"}, {"order_id": "new"})
    archive_transactions(tables, NOW)
    rows = tables.live_transactions()
    assert rows.count() == 1
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1
