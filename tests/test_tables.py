"""Stored tables: repeatable batches, committed reads, compaction, layout."""

import os
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import NOW
from samples import found, order, raw

from retailflow import files, schemas
from retailflow.session import scratch_folder
from retailflow.streaming import jobs
from retailflow.tables import CURRENT, GATHERED, READERS, TRANSACTION_COLUMNS, Tables


def ingest(tables, *changes, now=NOW):
    values = [order(**change) for change in changes]
    rows = raw(tables.spark, values) if values else raw(tables.spark, [order()]).limit(0)
    return jobs.ingest(tables, "transactions", rows, lambda: now)


def state(tables):
    return {name: found(tables.read(name)) for name in READERS}


def test_new_tables_are_empty_and_readable(tables):
    assert all(tables.exists(name) for name in schemas.STORED)
    assert all(rows == [] for rows in state(tables).values())
    tables.create()


def test_one_batch_fills_every_table(tables):
    ingest(tables, {}, {"quantity": 5, "city": "Waco", "user_id": "u2"}, {"price": None})
    assert found(tables.read("batch_details")) == [(0, "Books", 7, NOW)]
    assert found(tables.read("sales_by_payment")) == [(0, "PayPal", 7, NOW)]
    assert found(tables.read("sales_by_shipping")) == [(0, "Free", 7, NOW)]
    assert found(tables.read("sales_per_city")) == [
        ("Austin", "TX", 2, NOW),
        ("Waco", "TX", 5, NOW),
    ]
    assert found(tables.read("users"), "user_id") == [("u1",), ("u2",)]
    assert found(tables.read("products"), "product_id", "last_updated") == [("p1", NOW)]
    assert found(tables.read("payment_methods")) == [("PayPal", NOW)]
    assert found(tables.read("shipping_methods")) == [("Free", NOW)]
    assert found(tables.read("rejects"), "kind", "reject_reason", "batch_id") == [
        ("transactions", "missing:price", 0)
    ]
    log = tables.read("transaction_data")
    assert log.columns == [*TRANSACTION_COLUMNS, "processed_at", "event_date"]
    assert log.count() == 2


def test_repeating_a_batch_changes_nothing(tables):
    ingest(tables, {})
    before = state(tables)
    parsed = jobs.parse_events(raw(tables.spark, [order()]), "transactions")
    jobs.write_log(tables, "transactions", parsed, 0, NOW)
    jobs.derive_tables(tables, 0, NOW)
    assert state(tables) == before
    jobs.handle_batch(tables, "transactions")(parsed, 0)
    assert state(tables) == before


def test_a_batch_without_marker_is_not_read(tables):
    ingest(tables, {})
    before = state(tables)
    parsed = jobs.parse_events(raw(tables.spark, [order(quantity=9)]), "transactions")
    jobs.write_log(tables, "transactions", parsed, 1, NOW)
    jobs.derive_tables(tables, 1, NOW)
    assert state(tables) == before
    tables.commit("transactions", 1)
    assert found(tables.read("sales_per_city"), "total_quantity") == [(11,)]


def test_later_batch_wins_over_later_event(tables):
    ingest(tables, {"user_name": "New", "timestamp": "2024-03-01T09:00:00+00:00"})
    later = datetime(2024, 3, 1, 13)
    ingest(tables, {"user_name": "Old", "timestamp": "2024-01-01T09:00:00+00:00"}, now=later)
    assert found(tables.read("users"), "user_name", "last_updated") == [("Old", later)]
    assert found(tables.read("payment_methods"), "last_updated") == [(NOW,)]


def test_empty_batch(tables):
    ingest(tables)
    ingest(tables, {})
    assert tables.committed("transactions") == 1
    assert tables.read("transaction_data").count() == 1


def test_compaction_keeps_the_rows(tables):
    names = ("users", "products", "sales_per_city", "batch_details", "payment_methods")
    names += ("transaction_data", "rejects")
    for batch in range(6):
        ingest(
            tables,
            {"quantity": batch + 1, "user_name": f"n{batch}", "user_id": f"u{batch % 2}"},
            {"city": "Waco", "price": batch + 1, "product_id": f"p{batch % 3}"},
        )
        before = {name: found(tables.read(name)) for name in names}
        if batch in (1, 3, 4):
            for name in CURRENT:
                tables.compact(name)
                tables.compact(name)
            for name in GATHERED:
                tables.gather(name)
                tables.gather(name)
            assert {name: found(tables.read(name)) for name in names} == before
    assert found(tables.read("sales_per_city"), "city", "total_quantity") == [
        ("Austin", 21),
        ("Waco", 12),
    ]
    kept = files.names(tables.spark, tables.path("user_changes"))
    assert sorted(name for name in kept if "=" in name) == [f"batch_id={b}" for b in (4, 5)]
    kept = files.names(tables.spark, tables.path("quantity_totals"))
    assert sorted(name for name in kept if "=" in name) == [f"batch_id={b}" for b in (4, 5)]
    assert found(tables.read("batch_details"), "batch_id", "quantity") == [
        (batch, batch + 3) for batch in range(6)
    ]


def test_a_batch_committed_during_compaction_counts_once(tables, monkeypatch):
    ingest(tables, {"quantity": 2})
    fold = CURRENT["sales_per_city"].fold
    late = []

    def fold_while_a_stream_commits(rows):
        if not late:
            late.append(ingest(tables, {"quantity": 5}))
        return fold(rows)

    slow = replace(CURRENT["sales_per_city"], fold=fold_while_a_stream_commits)
    monkeypatch.setitem(CURRENT, "sales_per_city", slow)
    tables.compact("sales_per_city")
    assert late == [1]
    assert tables.committed("sales_per_city_snapshot") == 0
    assert found(tables.read("sales_per_city"), "total_quantity") == [(7,)]
    tables.compact("sales_per_city")
    assert found(tables.read("sales_per_city"), "total_quantity") == [(7,)]


def test_views_answer_sql(tables):
    ingest(tables, {}, {"order_id": "o2", "quantity": 150})
    tables.register_views()
    sql = tables.spark.sql
    assert sql("SELECT count(DISTINCT order_id) FROM transaction_data").first()[0] == 2
    assert sql("SELECT sum(quantity) FROM batch_details").first()[0] == 152
    assert sql("SELECT user_id FROM transaction_data WHERE quantity > 100").first()[0] == "u1"


def test_period_is_kept_with_the_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    Tables(spark, root, period="month").create()
    again = Tables(spark, root)
    assert (again.period, again.period_column) == ("month", "event_month")
    with pytest.raises(ValueError):
        Tables(spark, root, period="day")


@pytest.mark.parametrize("period, start", [("month", "2024-03-01"), ("year", "2024-01-01")])
def test_longer_periods_read_the_same(spark, tmp_path, period, start):
    made = Tables(spark, str(tmp_path / period), period=period)
    made.create()
    ingest(made, {}, {"timestamp": "2023-12-31T23:59:59+00:00"})
    folders = files.matches(spark, made.batch_path("transactions_log", 0) + "/status=*/*")
    assert any(folder.endswith(f"{made.period_column}={start}") for folder in folders)
    assert made.read("transaction_data").count() == 2


def test_hot_date_is_split_over_files(spark, tables):
    tables.rebalance = True
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100k")
    try:
        rows = spark.range(60_000, numPartitions=8).selectExpr(
            "uuid() AS order_id",
            "uuid() AS user_id",
            "TIMESTAMP '2024-03-01 08:00:00' + make_dt_interval(if(id % 3 = 0, id % 9, 0)) AS timestamp",
            "NULL AS value",
            "NULL AS reject_reason",
        )
        jobs.write_log(tables, "transactions", rows, 0, NOW)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    parts = files.matches(
        spark, tables.batch_path("transactions_log", 0) + "/status=accepted/event_date=*/*.parquet"
    )
    assert len(parts) > 2


def test_scratch_folder_follows_the_cluster(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(f"{shared}/retailflow/x-")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_many_batches_are_few_folders(tables):
    """3,000 batches are read through as many folders as 30, with the same rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = list(schemas.STORED["clickstream_log"].types)
    spark, folder = tables.spark, tables.path("clickstream_log")

    def add(batch):
        day = f"2024-03-{batch % 3 + 1:02d}"
        path = f"{folder}/batch_id={batch}/status=accepted/event_date={day}"
        os.makedirs(path)
        row = {name: [None] for name in names} | {"event_id": [f"e{batch}"]}
        table = pa.table({n: pa.array(v, pa.string()) for n, v in row.items() if n == "event_id"})
        pq.write_table(table, f"{path}/part-0.parquet")

    def listed():
        found = [f for f in tables.read("clickstream_logs").inputFiles()]
        return len({f.rpartition("/")[0] for f in found})

    counts = []
    for last in (29, 2999):
        for batch in range(tables.committed("clickstream") + 1, last + 1):
            add(batch)
        tables.commit("clickstream", last)
        tables.gather("clickstream_log")
        add(last + 1)
        tables.commit("clickstream", last + 1)
        tables.gather("clickstream_log")  # the batches of the first run are deleted now
        assert tables.read("clickstream_logs").select("event_id").distinct().count() == last + 2
        counts.append(listed())
        left = [n for n in files.names(spark, folder) if n.startswith("batch_id=")]
        assert left == [f"batch_id={last + 1}"]
    assert counts == [4, 4]  # three days and the newest batch


def test_only_touched_periods_are_rewritten(tables):
    ingest(tables, {"timestamp": "2024-02-01T08:00:00+00:00"}, {"order_id": "o2"})
    tables.gather("transactions_log")
    ingest(tables, {"order_id": "o3"})
    tables.gather("transactions_log")
    folders = {path.split("/")[-2]: through for path, through in tables.gathered("transactions_log")}
    assert folders == {"event_date=2024-02-01": 0, "event_date=2024-03-01": 1}
    written = tables._written("transactions_log")
    assert len(written) == 3  # the former folder of March stays for readers until the next run
    ingest(tables, {"order_id": "o4"})
    tables.gather("transactions_log")
    assert sorted(n for _, n in tables._written("transactions_log")) == [0, 1, 2]
    assert found(tables.read("transaction_data"), "order_id") == [(f"o{k}",) for k in range(1, 5)]


def test_a_reader_keeps_its_files(tables):
    ingest(tables, {})
    tables.gather("transactions_log")
    ingest(tables, {"order_id": "o2"})
    reader = tables.read("transaction_data")
    tables.gather("transactions_log")
    assert reader.count() == 2


def test_rows_without_a_time_are_gathered(tables):
    spark = tables.spark
    for batch in range(2):
        rows = raw(spark, ['{"event_id": "e%d"}' % batch, "{bad"])
        jobs.ingest(tables, "clickstream", rows, lambda: NOW)
        tables.gather("clickstream_log")
    assert found(tables.read("clickstream_logs"), "event_id", "timestamp") == [("e0", None), ("e1", None)]
    assert tables.read("rejects").count() == 2
    assert {p.split("/")[-2] for p, _ in tables.gathered("clickstream_log")} == {"event_date=2024-03-01"}


def test_a_failed_run_is_repeated(tables, monkeypatch):
    ingest(tables, {})
    before = state(tables)
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "commit", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.gather("transactions_log")
    assert state(tables) == before
    ingest(tables, {"order_id": "o2"})
    before = state(tables)
    tables.gather("transactions_log")
    assert state(tables) == before
    assert [through for _, through in tables.gathered("transactions_log")] == [1]


def test_row_groups_hold_disjoint_times(tables):
    """Gathered rows are sorted by time, so a report's time range skips row groups."""
    import pyarrow.parquet as pq

    spark = tables.spark
    rows = spark.range(40_000, numPartitions=4).selectExpr(
        "uuid() AS order_id",
        "uuid() AS user_id",
        "TIMESTAMP '2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7919 % 86400) AS timestamp",
        "NULL AS value",
        "NULL AS reject_reason",
    )
    jobs.write_log(tables, "transactions", rows, 0, NOW)
    tables.commit("transactions", 0)
    tables.gather("transactions_log", **{"parquet.block.size": "200000", "parquet.page.size": "20000"})
    ((folder, _),) = tables.gathered("transactions_log")
    times = []
    for path in files.files_below(spark, folder):
        if not path.endswith(".parquet"):
            continue
        data = pq.ParquetFile(path.removeprefix("file:"))
        groups = [data.metadata.row_group(k) for k in range(data.metadata.num_row_groups)]
        at = data.schema_arrow.names.index("timestamp")
        ranges = [(g.column(at).statistics.min, g.column(at).statistics.max) for g in groups]
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        times += ranges
    assert len(times) > 3


def test_two_writers_of_one_batch(tables, monkeypatch):
    """The second loader is refused before it writes, the second marker when it is made."""
    write, second = jobs.write_log, []

    def write_while_another_loads(*args):
        if not second:
            second.append(None)
            with pytest.raises(RuntimeError, match="another writer"):
                ingest(tables, {"order_id": "theirs"})
        write(*args)

    monkeypatch.setattr(jobs, "write_log", write_while_another_loads)
    ingest(tables, {"order_id": "ours"})
    assert second and found(tables.read("transaction_data"), "order_id") == [("ours",)]
    with pytest.raises(RuntimeError, match="another writer"):
        tables.commit("transactions", 0)
    ingest(tables, {"order_id": "next"})
    assert tables.committed("transactions") == 1


def test_a_failed_loader_releases_its_batch(tables, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "derive_tables", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest(tables, {})
    assert ingest(tables, {}) == 0
    tables.claim("transactions", 1, "a loader that died")
    with pytest.raises(RuntimeError, match="a loader that died"):
        ingest(tables, {})
    tables.release("transactions", 1)
    assert ingest(tables, {}) == 1


def test_markers_are_pruned(tables):
    for batch in range(105):
        tables.commit("s", batch)
    assert tables.committed("s") == 104
    assert len(files.names(tables.spark, f"{tables.root}/_commits/s")) <= 101 + 1
