"""The jobs that run beside the streams: coordinates load, daily and hourly reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from retailflow.catalog import Catalog
from retailflow.functions.timing import in_utc, instant
from retailflow.operators.coordinates import new_coordinates
from retailflow.plans.reports import (
    LARGE_ORDER,
    LINES_PER_MESSAGE,
    activity_message,
    daily_summary,
    daily_summary_merged,
    export_row,
    large_order_alert,
    large_orders,
)
from retailflow.sources.reference import (
    read_coordinates,
    rejected_coordinates,
    usable_coordinates,
)
from retailflow.tables import Tables


def load_coordinates(tables: Tables, csv_path: str) -> int:
    """Insert the cities of a CSV that are not stored yet; the number inserted.

    Rows that cannot be stored go to ``coordinate_rejects`` with their reason.

    Loading a file again inserts nothing, so the load needs no gate; one that must
    only ever run once can ask ``tables.committed("coordinates") < 0`` first.
    """
    load = tables.committed("coordinates") + 1
    lines = read_coordinates(tables.spark, csv_path)
    rows = new_coordinates(usable_coordinates(lines), tables.read("us_coordinates"))
    tables.write_batch("coordinate_loads", rows, load)
    tables.write_batch("coordinate_rejects", rejected_coordinates(lines), load)
    inserted = tables.read_batch("coordinate_loads", load).count()
    tables.commit("coordinates", load)
    return inserted


def load_coordinates_once(catalog: Catalog, csv_path: str) -> int:
    """Load the file if the catalog has no table of loads yet; the number inserted.

    The gate of the one-time load: a catalog that knows the table has been loaded. In a
    catalog that only lives in one process, the stored marker decides as well.
    """
    tables = catalog.tables
    if catalog.exists("coordinate_loads") or tables.committed("coordinates") >= 0:
        return 0
    inserted = load_coordinates(tables, csv_path)
    catalog.create()
    catalog.refresh()
    return inserted


def export_daily_summary(
    tables: Tables, transactions: DataFrame, as_of: datetime, merged: bool = False
) -> DataFrame:
    """Publish the day's summary row, which replaces that day's, and return it.

    ``merged`` takes it from the keys that the stream stored with each batch, instead of
    from the transactions.

    A row is a run of its own, there for readers once its marker is: they see the day's
    former row until then.
    """
    if merged:
        summary = daily_summary_merged(tables.read("daily_keys"), as_of)
    else:
        summary = daily_summary(transactions, as_of)
    row = export_row(summary).withColumn("as_of", instant(as_of))
    run = tables.committed("daily_reports") + 1
    tables.write_batch("daily_reports", row, run)
    tables.commit("daily_reports", run)
    day = in_utc(as_of).strftime("%Y-%m-%d")
    return tables.read("daily_summary").filter(F.col("date") == day)


def activity_update(tables: Tables, as_of: datetime) -> DataFrame:
    """The hourly activity message over the stored tables."""
    return activity_message(tables.read("transaction_data"), tables.changes("users"), as_of)


def large_order_check(
    tables: Tables,
    as_of: datetime,
    folder: str,
    threshold: int = LARGE_ORDER,
    lines_per_message: int = LINES_PER_MESSAGE,
) -> DataFrame:
    """Store the messages of the hourly alert over the stored transactions, and return them.

    ``folder`` is a scratch path that can be deleted afterwards.
    """
    found = large_orders(tables.read("transaction_data"), as_of, threshold)
    messages = large_order_alert(found, folder, lines_per_message)
    run = tables.committed("alerts") + 1
    tables.write_batch("alerts", messages.withColumn("as_of", instant(as_of)), run)
    tables.commit("alerts", run)
    return tables.read_batch("alerts", run).select("part", "body", "found")
