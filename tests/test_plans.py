"""Plans: pushed filters, pruned columns and folders, combining before shuffles, skew."""

import ast
from pathlib import Path

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from samples import order, raw

import retailflow
from retailflow.functions.timing import instant, older_than
from retailflow.operators import latest, totals
from retailflow.plans import reports
from retailflow.streaming import jobs


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from retailflow.tables import Tables

    tables = Tables(spark, str(tmp_path_factory.mktemp("plans")))
    tables.create()
    rows = [order(timestamp=f"2024-0{month}-01T08:00:00+00:00") for month in (1, 2, 3)]
    jobs.ingest(tables, "transactions", raw(spark, rows), lambda: NOW)
    return tables


def test_reports_prune_folders_rows_and_columns(stored):
    text = plan(reports.daily_summary(stored.read("transaction_data"), NOW))
    assert "event_date#" in text and ">= 2024-03-01)" in text
    assert "GreaterThanOrEqual(timestamp,2024-03-01" in text
    assert (
        "ReadSchema: struct<order_id:string,user_id:string,price:decimal(10,2),"
        "quantity:int,timestamp:timestamp>" in text
    )


def test_only_recent_folders_are_read(stored):
    recent = reports.large_orders(stored.read("transaction_data"), NOW, 0)
    recent.collect()
    scans = recent._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.head().metrics().apply("numFiles").value() == 1


def test_large_order_filter_is_pushed(stored):
    text = plan(reports.large_orders(stored.read("transaction_data"), NOW))
    assert "GreaterThan(quantity,100)" in text


def test_archive_filter_is_pushed(stored):
    text = plan(older_than(stored.live_transactions(), instant(NOW)))
    assert "LessThan(timestamp,2024-03-01 12:00" in text
    assert "<= 2024-03-01)" in text


def test_totals_combine_before_one_shuffle(stored):
    text = plan(totals.quantity_totals(stored.read("transaction_data")))
    assert text.count("Arguments: hashpartitioning") == 1
    assert "partial_sum" in text.split("Arguments: hashpartitioning")[0]


def test_latest_combines_before_the_shuffle(stored):
    text = plan(latest.latest_users(stored.read_batch("transactions_log", 0), F.lit(NOW)))
    assert text.count("Arguments: hashpartitioning") == 1
    assert "partial_max" in text.split("Arguments: hashpartitioning")[0]


def test_users_today_filters_the_changes(stored):
    text = plan(reports.users_active_today(stored.changes("users"), NOW))
    assert "GreaterThanOrEqual(last_updated,2024-03-01" in text


def test_archive_moves_rows_without_a_shuffle(stored):
    old = older_than(stored.live_transactions(), instant(NOW)).drop("batch_id")
    assert "Exchange" not in plan(old) and "Join" not in plan(old)


# Calls that bring rows to the driver, run Python per row, or tie data to one machine.
FORBIDDEN = {
    "collect", "toPandas", "udf", "pandas_udf", "rdd", "localCheckpoint", "crossJoin",
    "mapPartitions", "applyInPandas", "mapInPandas", "cache", "persist", "isEmpty",
    "isEmpty",
}
# One-row, per-row-iterator or bounded uses.
ALLOWED = {
    ("__main__.py", "toLocalIterator"),  # printing a report
    ("tables.py", "first"),  # the archive's state row
    ("tables.py", "collect"),  # the period folders that new batches touch
    ("catalog.py", "collect"),  # the partitions of a table
}


def test_nothing_leaves_spark():
    package = Path(retailflow.__file__).parent
    found_calls = set()
    for path in package.rglob("*.py"):
        if path.is_relative_to(package / "llm"):  # has its own tests and may use Arrow
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and (
                node.attr in FORBIDDEN or node.attr in {"first", "toLocalIterator", "head", "take"}
            ):
                found_calls.add((path.name, node.attr))
    assert found_calls <= ALLOWED


def test_merged_summary_expands_nothing(spark, stored):
    rows = [order(order_id=f"o{k}", user_id=f"u{k % 3}", quantity=k) for k in range(1, 20)]
    for batch in (rows[:12], rows[6:]):
        number = stored.committed("transactions") + 1
        parsed = jobs.parse_events(raw(spark, batch), "transactions")
        jobs.handle_batch(stored, "transactions", lambda: NOW, daily=True)(parsed, number)
    merged = reports.daily_summary_merged(stored.read("daily_keys"), NOW)
    assert "Expand" not in plan(merged)
    direct = reports.daily_summary(stored.read("transaction_data").filter("order_id <> 'o1' OR user_id = 'u1'"), NOW)
    own, other = merged.first(), direct.first()
    assert (own["orders"], own["users"]) == (19, 3)
    assert own["total_quantity"] == sum(range(1, 13)) + sum(range(7, 20))
    assert own["total_revenue"] == own["total_quantity"] * 12.5 and own["date"] == other["date"]


def test_folding_a_bucketed_snapshot_moves_changes_only(spark, tmp_path):
    from retailflow.catalog import Catalog
    from retailflow.snapshots import Snapshots
    from retailflow.tables import Tables

    tables = Tables(spark, str(tmp_path / "t"))
    tables.create()
    catalog = Catalog(tables, "bucketed")
    catalog.create()
    snapshots = Snapshots(catalog, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for batch in range(4):
        rows = [order(user_id=f"u{k}", user_name=f"n{batch}") for k in range(batch, 40, batch + 1)]
        jobs.ingest(tables, "transactions", raw(spark, rows), lambda: NOW)
        if batch in (0, 2):
            snapshots.compact("users")
            snapshots.compact("users")
        folded = snapshots.current("users")
        assert sorted(folded.collect()) == sorted(tables.read("users").select(folded.columns).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = snapshots.current("users")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    (scan,) = [k for k, line in enumerate(lines) if "Bucketed: true" in line]
    # What stands above the scan of the snapshot: the lines before it that are less indented.
    depth, above = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line)
            depth = at
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_a_bucketed_snapshot_outlives_its_catalog(spark, tmp_path):
    from retailflow.catalog import Catalog
    from retailflow.snapshots import Snapshots
    from retailflow.tables import Tables

    tables = Tables(spark, str(tmp_path / "t"))
    tables.create()
    catalog = Catalog(tables, "first_process")
    catalog.create()
    jobs.ingest(tables, "transactions", raw(spark, [order(), order(user_id="u2")]), lambda: NOW)
    Snapshots(catalog, 8).compact("users")
    spark.sql("DROP DATABASE first_process CASCADE")
    again = Catalog(tables, "second_process")
    again.create()
    assert Snapshots(again, 8).current("users").count() == 2
    spark.sql("DROP DATABASE second_process CASCADE")
