"""What is written and shuffled grows no faster than the rows, and reads stay whole."""

import gzip
import re
from datetime import datetime
from pathlib import Path

import pytest
from conftest import NOW, SF_DIR
from pyspark.sql import functions as F
from samples import order, raw

from retailflow import files, fixtures, tables as stored
from retailflow.operators.totals import daily_keys
from retailflow.plans import archive
from retailflow.plans.archive import archive_transactions
from retailflow.session import PART, SMALL_PART, configure, sized_files
from retailflow.streaming import jobs
from retailflow.tables import Tables


def ingest(tables, *ids, month=3):
    rows = [order(order_id=i, timestamp=f"2024-{month:02d}-01T08:00:00+00:00") for i in ids]
    jobs.ingest(tables, "transactions", raw(tables.spark, rows), lambda: NOW)


def ids(tables):
    return sorted(r[0] for r in tables.read("transaction_data").select("order_id").collect())


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


# -- landing

def test_landed_records_are_compressed(spark):
    pattern = next(fixtures.land_batches(spark, SF_DIR, "transactions"))
    (folder,) = files.matches(spark, pattern)
    text = spark.read.text(folder).agg(F.sum(F.length("value"))).first()[0]
    assert files.size(spark, folder) * 4 < text


def test_landed_files_are_bounded(spark, monkeypatch):
    """A compressed file cannot be split, so none holds all records of a task."""
    monkeypatch.setitem(fixtures.LANDED, "maxRecordsPerFile", 10)
    rows = spark.range(95, numPartitions=1).select(F.col("id").cast("string").alias("value"))
    folder = fixtures.land(rows, "bounded").removeprefix("file:")
    parts = [gzip.open(p).read().split() for p in Path(folder).glob("*.gz")]
    assert max(map(len, parts)) == 10
    assert sorted(int(n) for part in parts for n in part) == list(range(95))


def test_landing_does_not_change_the_session(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    next(fixtures.land_batches(spark, SF_DIR, "transactions"))
    assert spark.conf.get(name) == before


def test_orders_meet_their_customers_before_the_line_items(spark):
    text = plan(fixtures.transactions(spark, SF_DIR))
    depth = {
        key: len(re.match(r"[ :+-]*", line)[0])
        for line in text.splitlines()
        for key in ("o_custkey", "l_orderkey", "l_partkey")
        if re.search(rf"Join Inner, \(.*{key}", line)
    }
    assert depth["l_orderkey"] < min(depth["o_custkey"], depth["l_partkey"])


def test_a_large_table_is_not_dealt_out(spark, monkeypatch):
    dealt = fixtures.inventory(spark, SF_DIR)
    assert "Repartition" in plan(dealt)
    monkeypatch.setattr(fixtures, "SPLIT", 1)
    scanned = fixtures.inventory(spark, SF_DIR)
    assert "Repartition" not in plan(scanned)
    assert scanned.exceptAll(dealt).isEmpty() and dealt.exceptAll(scanned).isEmpty()


# -- shuffles

def test_shuffles_are_read_in_small_parts_but_files_are_not(spark):
    assert configure(spark).conf.get(PART) == SMALL_PART
    with sized_files(spark):
        assert spark.conf.get(PART) == "64m"
    assert spark.conf.get(PART) == SMALL_PART
    spark.conf.set(PART, "8m")  # the cluster's own
    try:
        assert configure(spark).conf.get(PART) == "8m"
        with sized_files(spark):
            assert spark.conf.get(PART) == "8m"
    finally:
        spark.conf.set(PART, SMALL_PART)


# -- batches

def test_daily_keys_carry_no_sums(spark):
    rows = [
        ("o1", "u1", 2, 1.5), ("o1", "u1", 2, 1.5), ("o2", "u1", None, 1.0), (None, "u2", 1, None),
    ]
    schema = "order_id string, user_id string, quantity int, price double"
    events = spark.createDataFrame(rows, schema).selectExpr(
        "order_id", "user_id", "quantity", "CAST(price AS DECIMAL(10,2)) AS price",
        "TIMESTAMP '2024-03-01 08:00:00' AS timestamp",
    )
    keys = daily_keys(events)
    assert "Expand" not in plan(keys)  # every group of which would carry both sums
    found = {(r["kind"], r["key"]): (r["quantity"], r["revenue"]) for r in keys.collect()}
    assert found.pop(("sums", None)) == (5, 6)
    assert found == dict.fromkeys(
        [("orders", "o1"), ("orders", "o2"), ("orders", None), ("users", "u1"), ("users", "u2")],
        (None, None),
    )
    assert keys.count() == 6


# -- gathering

def folders(tables):
    return [(path.split("/")[-2], n) for path, n in tables.gathered("transactions_log")]


def test_full_folders_are_not_rewritten(tables, monkeypatch):
    monkeypatch.setattr(stored, "FULL", 1)
    for batch in range(3):
        ingest(tables, f"o{batch}")
        tables.gather("transactions_log")
    assert folders(tables) == [("event_date=2024-03-01", n) for n in range(3)]
    for path, _ in tables.gathered("transactions_log"):
        assert tables.spark.read.parquet(path).count() == 1
    assert ids(tables) == ["o0", "o1", "o2"]


def test_rows_after_a_full_folder_are_merged_beside_it(tables, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(stored, "FULL", 1)
        ingest(tables, "full")
        tables.gather("transactions_log")
    for batch in range(3):
        ingest(tables, f"o{batch}")
        tables.gather("transactions_log")
    assert [n for _, n in folders(tables)] == [0, 3]
    assert ids(tables) == ["full", "o0", "o1", "o2"]


def test_a_folder_that_fills_takes_in_the_former(tables, monkeypatch):
    ingest(tables, "a")
    tables.gather("transactions_log")
    monkeypatch.setattr(stored, "FULL", 1)
    ingest(tables, "b")
    tables.gather("transactions_log")
    assert [n for _, n in folders(tables)] == [1]
    ingest(tables, "c")
    tables.gather("transactions_log")
    assert [n for _, n in folders(tables)] == [1, 2]
    assert ids(tables) == ["a", "b", "c"]


def test_large_and_small_periods_are_gathered_together(tables, monkeypatch):
    ingest(tables, *[f"big{n}" for n in range(3000)])
    size = files.size(tables.spark, tables.path("transactions_log"))
    monkeypatch.setattr(stored, "FULL", size // 2)
    ingest(tables, "small", month=2)
    tables.gather("transactions_log")
    full = [path.split("/")[-2] for path in tables._full("transactions_log")]
    assert full == ["event_date=2024-03-01"]
    assert sorted(p for p, _ in folders(tables)) == ["event_date=2024-02-01", "event_date=2024-03-01"]
    assert len(ids(tables)) == 3001


@pytest.mark.parametrize("later", [False, True])
def test_full_folders_of_a_failed_run_do_not_count(tables, monkeypatch, later):
    monkeypatch.setattr(stored, "FULL", 1)
    ingest(tables, "a")
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "commit", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.gather("transactions_log")
    if later:
        ingest(tables, "b")
    tables.gather("transactions_log")
    assert ids(tables) == ["a", "b"] if later else ["a"]
    assert len(folders(tables)) == 1


def test_stored_rows_are_compressed_well(tables):
    ingest(tables, "a")
    tables.gather("transactions_log")
    pattern = tables.root + "/transactions_log*/*/*/*/part-*"
    found = files.matches(tables.spark, pattern)
    assert len(found) > 1 and all(".zstd." in path for path in found)


def test_gathered_parts_are_sorted_once(tables, monkeypatch):
    """What is written is sorted by its folders already, so the writer does not sort it again."""
    for month in (2, 3):
        ingest(tables, "a", "b", month=month)
    monkeypatch.setattr(stored, "FULL", 1)  # two parts, one for each period
    kind, seen = type(tables.spark.range(1)), []
    write = kind.write
    with monkeypatch.context() as patch:
        patch.setattr(kind, "write", property(lambda rows: seen.append(rows) or write.fget(rows)))
        tables.gather("transactions_log")
    (rows,) = seen
    assert "Union" in plan(rows) and plan(rows).count("Sort [") == 1
    order = rows._jdf.queryExecution().optimizedPlan().outputOrdering().mkString(" ")
    names = re.findall(r"(\w+)#\d+L? ASC", order)
    assert names[:4] == ["status", "event_date", "through", "timestamp"]
    # The writer replaces text that may be null, and with it the order.
    assert not rows.schema["status"].nullable
    assert ids(tables) == ["a", "a", "b", "b"]


@pytest.mark.parametrize("full", [1, stored.FULL])
def test_a_folder_column_that_is_null_stays_null(tables, monkeypatch, full):
    monkeypatch.setattr(stored, "FULL", full)
    ingest(tables, "a")
    (row,) = tables.read_stored("transactions_log", "transactions").collect()
    batch = tables.spark.createDataFrame([row], tables.layout("transactions_log").read_schema)
    tables.write_batch("transactions_log", batch.withColumn("status", F.lit(None)), 1)
    tables.commit("transactions", 1)
    before = tables.read_stored("transactions_log", "transactions").collect()
    tables.gather("transactions_log")
    after = tables.read_stored("transactions_log", "transactions").select(*before[0].__fields__)
    assert sorted(map(str, after.collect())) == sorted(map(str, before))
    assert sorted(str(r["status"]) for r in before) == ["None", "accepted"]


# -- archive

def test_the_archive_reads_small_parts(tables, monkeypatch):
    name, write, seen = "spark.sql.files.maxPartitionBytes", Tables.write_batch, {}

    def spy(self, table, rows, batch_id):
        seen[table] = self.spark.conf.get(name)
        write(self, table, rows, batch_id)

    before = tables.spark.conf.get(name)
    ingest(tables, "a", month=1)
    monkeypatch.setattr(Tables, "write_batch", spy)
    archive_transactions(tables, datetime(2026, 1, 1))
    assert seen["archived_transactions"] == archive.READ_PART
    assert tables.spark.conf.get(name) == before
    assert tables.read("archived_transaction_data").count() == 1
