"""The stored tables as tables of the session catalog, for SQL by name.

Every stored table is an external table over its batches, partitioned like them, and gathered
ones have a second over the gathered folders. Only published folders are registered as
partitions, so a query sees all of a batch or nothing. The names reports use are views over
these, with what the archive has taken left out.

Spark's default catalog lives in one process: another session of it sees the tables, another
process has to create them again. A shared metastore keeps them; the folders stay the truth.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from retailflow import files
from retailflow.schemas import STORED
from retailflow.tables import GATHERED, TRANSACTION_COLUMNS, Tables

#: The stream or job that numbers the batches of each stored table.
STREAMS = {
    **{name: stream for name, (stream, _) in GATHERED.items()},
    "user_changes": "transactions",
    "product_changes": "transactions",
    "coordinate_loads": "coordinates",
    "coordinate_rejects": "coordinates",
    "alerts": "alerts",
    "archived_transactions": "archive",
    "archive_runs": "archive",
    "daily_reports": "daily_reports",
    "stream_progress": "stream_progress",
}


class Catalog:
    """The tables below ``tables`` in ``database``."""

    def __init__(self, tables: Tables, database: str):
        self.tables, self.spark, self.database = tables, tables.spark, database

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self) -> None:
        """Create the database and the tables that are not there; those there are left alone."""
        location = f"{self.tables.root}/_database"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{location}'")
        for table in STORED:
            layout = self.tables.layout(table)
            parts = ("batch_id", *layout.partitions)
            self._create(table, layout.read_schema, parts, self.tables.path(table))
            if table in GATHERED:
                path = self.tables.gathered_path(table)
                files.create_folder(self.spark, path)
                parts = (*layout.partitions, "through")
                self._create(f"{table}_gathered", layout.gathered_schema, parts, path)

    def _create(self, table: str, schema, partitions, location: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}'"
        )

    def refresh(self) -> None:
        """Register what has been published since, drop what was gathered, renew the views."""
        for table, stream in STREAMS.items():
            partitions = self.tables.layout(table).partitions
            depth = "/*=*" * len(partitions)
            published, gathered = self.tables.committed(stream), -1
            if table in GATHERED:
                gathered = self.tables.committed(f"{table}_gathered")
                self._register(f"{table}_gathered", [path for path, _ in self.tables.gathered(table)])
            found = files.matches(self.spark, f"{self.tables.path(table)}/batch_id=*{depth}")
            batches = ((int(re.search(r"batch_id=(\d+)", path)[1]), path) for path in found)
            self._register(table, [p for b, p in batches if gathered < b <= published])
        self._create_views()

    def _register(self, table: str, folders: list[str]) -> None:
        """Make ``folders`` the partitions of a table."""
        wanted = {"/".join(p for p in path.split("/") if "=" in p): path for path in folders}
        have = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()}
        for added, specs in ((False, have - set(wanted)), (True, set(wanted) - have)):
            if specs:
                clauses = [
                    f"PARTITION ({_literals(spec)})" + (f" LOCATION '{wanted[spec]}'" if added else "")
                    for spec in sorted(specs)
                ]
                change, comma = ("ADD IF NOT EXISTS ", " ") if added else ("DROP IF EXISTS ", ", ")
                self.spark.sql(f"ALTER TABLE {self.name(table)} {change}{comma.join(clauses)}")

    def _create_views(self) -> None:
        run = self.tables.archive_run()
        left = "status = 'accepted'"
        if run is not None:
            cutoff, through = run
            time = f"TIMESTAMP '{cutoff:%Y-%m-%d %H:%M:%S.%f}+00:00'"
            left += f" AND (timestamp >= {time} OR batch_id > {through})"
        period, totals = self.tables.period_column, ("quantity", "processed_at")
        views = {
            "transaction_data": (
                "transactions_log", [*TRANSACTION_COLUMNS, "processed_at", period], left
            ),
            "clickstream_logs": (
                "clickstream_log", [*_events("clickstream"), period], "status = 'accepted'"
            ),
            "inventory_updates": (
                "inventory_log", [*_events("inventory"), period], "status = 'accepted'"
            ),
        }
        for view, dimension, key in (
            ("batch_details", "category", "category"),
            ("sales_by_payment", "payment", "payment_method"),
            ("sales_by_shipping", "shipping", "shipping_method"),
        ):
            columns = ["batch_id", key, *totals]
            views[view] = ("quantity_totals", columns, f"dimension = '{dimension}'")
        for view, (table, columns, kept) in views.items():
            parts = (
                f"SELECT {', '.join(columns)} FROM {self.name(name)} WHERE {kept}"
                for name in (table, f"{table}_gathered")
            )
            query = " UNION ALL ".join(parts)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS {query}")

    def describe(self) -> DataFrame:
        """A row for each column of each table: table, column, type, whether it is a partition."""
        rows = [
            (table, c.name, c.dataType, c.isPartition)
            for table in sorted([*STORED, *(f"{t}_gathered" for t in GATHERED)])
            for c in self.spark.catalog.listColumns(self.name(table))
        ]
        return self.spark.createDataFrame(
            rows, "`table` string, `column` string, type string, `partition` boolean"
        )

    def counts(self) -> DataFrame:
        """The number of rows of each stored table, by SQL."""
        parts = []
        for table in STORED:
            both = [table] + [f"{table}_gathered"] * (table in GATHERED)
            sums = " + ".join(f"(SELECT count(*) FROM {self.name(t)})" for t in both)
            parts.append(f"SELECT '{table}' AS `table`, {sums} AS `rows`")
        return self.spark.sql(" UNION ALL ".join(parts))


def _events(kind: str) -> list[str]:
    return [c for c in STORED[f"{kind}_log"].types if c not in ("value", "reject_reason")]


def _literals(spec: str) -> str:
    pairs = (part.split("=", 1) for part in spec.split("/"))
    return ", ".join(f"{name} = '{value}'" for name, value in pairs)
