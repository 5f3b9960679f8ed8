"""The stored tables: batch-wise idempotent writes, and reads of committed batches only.

Every batch of a table has its own folder, so repeating a batch replaces it. A batch
counts once its marker exists; the marker is written after all tables of that batch,
so readers see all of a batch or nothing. Current tables are a log of per-batch
changes, folded on read and folded for good by :meth:`Tables.compact`.

Logs gather their closed batches by period (:meth:`Tables.gather`): a job rewrites the period
folders that have new rows, and a marker publishes them all. A reader lists a folder for each
period, those of it that are full, and the batches since, however many batches there have been.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retailflow import files
from retailflow.functions.timing import PERIODS, instant, period_start
from retailflow.operators.latest import latest
from retailflow.schemas import DIMENSIONS, EVENTS, STORED, Layout, columns
from retailflow.session import sized_files

MARKERS_KEPT = 100
COMPRESSION = "zstd"

# A gathered folder made from so many bytes is full: it is not rewritten, what comes later goes
# to a folder beside it.
FULL = 16 << 20
RUNNING = "running_totals"

# The tables whose batches are gathered: the stream that numbers them, and the time their rows
# are sorted by.
GATHERED = {
    **{f"{kind}_log": (kind, "timestamp") for kind in EVENTS},
    "quantity_totals": ("transactions", "processed_at"),
    RUNNING: (RUNNING, "processed_at"),
    "daily_keys": ("transactions", "day"),
    "stream_progress": ("stream_progress", "at"),
}


class Tables:
    """Tables below one folder.

    ``period`` is how much event time one log folder covers: "day" for live traffic,
    longer where a batch spreads thin over a long history and days would make tiny
    files. It is kept with the tables; opening them again needs no argument.

    ``rebalance`` shuffles a batch to its folders before it is written: sized files, and a
    hot folder split over many, at the price of moving every row. It is for a backfill that
    spreads over many folders. Live batches fill the folders of a day or two from each task
    and are written as they come; gathering sizes their files later.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        period: str | None = None,
        rebalance: bool = False,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rebalance = rebalance
        stored = files.names(spark, f"{self.root}/_period")
        if stored and period not in (None, stored[0]):
            raise ValueError(f"the tables are partitioned by {stored[0]}, not by {period}")
        self.period = stored[0] if stored else period or "day"
        self.period_column = PERIODS[self.period]

    # -- folders and markers

    def layout(self, table: str) -> Layout:
        return STORED[table].by(self.period_column)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def batch_path(self, table: str, batch_id: int) -> str:
        return f"{self.path(table)}/batch_id={batch_id}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/_checkpoints/{stream}"

    def exists(self, table: str) -> bool:
        return files.exists(self.spark, self.path(table))

    def create(self) -> None:
        """Make every table readable; those that exist are left alone."""
        files.create_marker(self.spark, f"{self.root}/_period/{self.period}")
        for table in STORED:
            if not self.exists(table):
                files.create_folder(self.spark, self.path(table))

    def committed(self, stream: str) -> int:
        """The last published batch of ``stream``, -1 if there is none."""
        found = files.names(self.spark, f"{self.root}/_commits/{stream}")
        return max((int(name) for name in found if name.isdigit()), default=-1)

    def commit(self, stream: str, batch_id: int) -> None:
        """Publish a batch; refused if another writer has published it."""
        folder = f"{self.root}/_commits/{stream}"
        if not files.create_marker(self.spark, f"{folder}/{batch_id}"):
            raise RuntimeError(f"another writer has published batch {batch_id} of {stream}")
        # Numbers may have gaps, so whatever is old goes, not one name.
        for name in files.names(self.spark, folder):
            if name.isdigit() and int(name) <= batch_id - MARKERS_KEPT:
                files.delete(self.spark, f"{folder}/{name}")

    def _claim(self, stream: str, batch_id: int) -> str:
        return f"{self.root}/_claims/{stream}/{batch_id}"

    def claim(self, stream: str, batch_id: int, owner: str) -> None:
        """Keep others from writing a batch; refused if another ``owner`` has it.

        An owner may claim a batch again, to repeat it. A claim lasts until :meth:`release`,
        also of an owner that died.
        """
        holder = files.claim(self.spark, self._claim(stream, batch_id), owner)
        if holder != owner:
            raise RuntimeError(
                f"another writer, {holder}, is writing batch {batch_id} of {stream}; "
                "release the batch if it is gone"
            )

    def release(self, stream: str, batch_id: int) -> None:
        files.delete(self.spark, self._claim(stream, batch_id))

    # -- writing

    def filed(self, rows: DataFrame, time: str) -> DataFrame:
        """``rows`` with the folder column of the period of a time."""
        return rows.withColumn(self.period_column, period_start(F.col(time), self.period))

    def read_folder(self, kind: str) -> str:
        """Where the files that a topic's stream has read are moved to."""
        return f"{self.root}/_read/{kind}"

    def write_batch(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Replace one batch of ``table`` by ``rows``, matched to its columns by name."""
        layout = self.layout(table)
        types = {field.name: field.dataType for field in layout.read_schema}
        wanted = [*layout.types, *layout.partitions]
        have = set(rows.columns)
        rows = rows.select(
            *[
                (F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c)
                for c in wanted
            ]
        )
        if layout.partitions and self.rebalance:
            # Sized files per partition; adaptive execution splits a hot partition.
            rows = rows.hint("rebalance", *layout.partitions)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer = writer.option("compression", COMPRESSION).partitionBy(*layout.partitions)
        with sized_files(self.spark) if self.rebalance else nullcontext():
            writer.parquet(self.batch_path(table, batch_id))

    # -- reading

    def read_batch(self, table: str, batch_id: int) -> DataFrame:
        return (
            self.spark.read.schema(self.layout(table).read_schema)
            .option("basePath", self.path(table))
            .parquet(self.batch_path(table, batch_id))
        )

    def read_stored(self, table: str, stream: str, after: int = -1) -> DataFrame:
        """All rows of the committed batches, or of those after one, with ``batch_id``."""
        gathered = self.committed(f"{table}_gathered") if table in GATHERED else -1
        rows = self._recent(table, max(gathered, after), self.committed(stream))
        folders = [path for path, through in self.gathered(table) if through > after]
        if folders:
            rows = rows.unionByName(self._read_gathered(table, folders).filter(F.col("batch_id") > after))
        return rows

    def _recent(self, table: str, after: int, last: int) -> DataFrame:
        rows = self.spark.read.schema(self.layout(table).read_schema).parquet(self.path(table))
        rows = rows.filter(F.col("batch_id") <= last)
        return rows if after < 0 else rows.filter(F.col("batch_id") > after)

    def _read_gathered(self, table: str, folders: list[str]) -> DataFrame:
        return (
            self.spark.read.schema(self.layout(table).gathered_schema)
            .option("basePath", self.gathered_path(table))
            .parquet(*folders)
            .drop("through")
        )

    # -- gathering batches

    def gathered_path(self, table: str) -> str:
        return f"{self.path(table)}_gathered"

    def gathered(self, table: str) -> list[tuple[str, int]]:
        """Folder and last batch of each period's rows as published: the one written last, and
        those that are full.

        Folders of later batches are of a run that is not published, or never will be.
        """
        last = self.committed(f"{table}_gathered") if table in GATHERED else -1
        if last < 0:
            return []
        newest: dict[str, int] = {}
        for period, through in self._written(table):
            if newest.get(period, -1) < through <= last:
                newest[period] = through
        found = {(f"{period}/through={through}", through) for period, through in newest.items()}
        for folder in self._full(table):
            through = int(folder.rpartition("=")[2])
            if through <= last:
                found.add((folder, through))
        return sorted(found, key=lambda pair: pair[1])

    def _full(self, table: str) -> list[str]:
        found = files.matches(self.spark, f"{self.gathered_path(table)}/*/*/through=*/_full")
        return [path.removesuffix("/_full") for path in found]

    def _written(self, table: str) -> list[tuple[str, int]]:
        """Period folder and last batch of all that gathering has written."""
        found = files.matches(self.spark, f"{self.gathered_path(table)}/*/*/through=*")
        pairs = (path.rpartition("/through=") for path in found)
        return [(period, int(through)) for period, _, through in pairs]

    def gather(self, table: str, **options: str) -> None:
        """Rewrite the period folders that closed batches have rows for, and publish them.

        A folder gets its former rows and the new ones, sorted by time, as a new folder
        beside the former: replacing files in place could lose rows when a run dies, or
        change them under a reader. A former folder that is full stays as it is, so what a row
        costs does not grow with the rows before it. What the state before this one used stays
        until the next run, for readers that have started; what is older is deleted. A run that
        fails before its marker has changed nothing; the next one deletes what it left.
        ``options`` go to the writer.
        """
        stream, time = GATHERED[table]
        name, last = f"{table}_gathered", self.committed(stream)
        previous = self.committed(name)
        if last <= previous:
            return
        layout, root = self.layout(table), self.gathered_path(table)
        for period, through in self._written(table):
            if through > previous:
                files.delete(self.spark, f"{period}/through={through}")
        used, full = self.gathered(table), self._full(table)
        rows = self._recent(table, previous, last)
        # As many as there are period folders.
        touched = {
            "/".join(f"{c}={row[c]}" for c in layout.partitions)
            for row in rows.select(*layout.partitions).distinct().collect()
        }
        former = {
            "/".join(path.split("/")[-3:-1]): path for path, _ in used if path not in full
        }
        large = self._large(table, previous, last, former)
        # No text is null, which is the same folder: the writer would replace such columns by
        # its own, not see that the rows are sorted by them, and sort once more.
        texts = {f.name for f in layout.read_schema if f.dataType == T.StringType()}
        wanted = [
            *layout.types,
            "batch_id",
            *[F.coalesce(c, F.lit("")).alias(c) if c in texts else c for c in layout.partitions],
        ]

        def with_former(rows: DataFrame, periods: Iterable[str]) -> DataFrame:
            paths = [former[period] for period in periods if period in former]
            if paths:
                rows = rows.unionByName(self._read_gathered(table, paths))
            return rows.select(*wanted).withColumn("through", F.lit(last))

        # A period with many rows fills files by itself: its rows are read together, not shuffled.
        parts = [
            with_former(self._read_batches(table, paths), [period]).coalesce(parts)
            for period, (paths, parts) in large.items()
        ]
        small = touched - set(large)
        if small or not large:
            if large:
                period = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in layout.partitions])
                rows = rows.filter(period.isin(*small))
            # Sized files; adaptive execution splits a hot period.
            parts.append(with_former(rows, small).hint("rebalance", *layout.partitions))
        # Row groups that hold a stretch of time each are skipped by their statistics. The parts
        # are sorted together: a union of sorted ones does not count as sorted.
        order = (*layout.partitions, "through", time)
        with sized_files(self.spark):
            (
                reduce(DataFrame.unionByName, parts)
                .sortWithinPartitions(*order)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", COMPRESSION)
                .options(**options)
                .partitionBy(*layout.partitions, "through")
                .parquet(root)
            )
        for period in large:
            files.create_marker(self.spark, f"{root}/{period}/through={last}/_full")
        self.commit(name, last)
        kept = {path for path, _ in used}
        for period, through in self._written(table):
            if through <= previous and f"{period}/through={through}" not in kept:
                files.delete(self.spark, f"{period}/through={through}")
        for folder in files.names(self.spark, self.path(table)):
            number = folder.removeprefix("batch_id=")
            if number.isdigit() and int(number) <= previous:
                files.delete(self.spark, f"{self.path(table)}/{folder}")

    def _large(
        self, table: str, after: int, last: int, former: dict[str, str]
    ) -> dict[str, tuple[list[str], int]]:
        """The periods whose new rows and former folder fill one: the folders of the new rows,
        and in how many parts, each less than full, they are written.

        There are two parts at least; a union of single ones would be one task.
        """
        given = [self.path(table), *former.values()]
        if sum(files.size(self.spark, path) for path in given) < FULL:
            return {}
        depth = "/*=*" * len(self.layout(table).partitions)
        found: dict[str, list[str]] = {}
        for path in files.matches(self.spark, f"{self.path(table)}/batch_id=*{depth}"):
            batch, period = re.search(r"/batch_id=(\d+)/(.+)$", path).groups()
            if after < int(batch) <= last:
                found.setdefault(period, []).append(path)
        sizes = {
            period: sum(
                files.size(self.spark, path)
                for path in (*paths, *([former[period]] if period in former else ()))
            )
            for period, paths in found.items()
        }
        return {
            period: (found[period], size // FULL + 1)
            for period, size in sizes.items()
            if size >= FULL
        }

    def _read_batches(self, table: str, folders: list[str]) -> DataFrame:
        return (
            self.spark.read.schema(self.layout(table).read_schema)
            .option("basePath", self.path(table))
            .parquet(*folders)
        )

    def read(self, name: str) -> DataFrame:
        """A table by the name reports use; see :data:`READERS`."""
        return READERS[name](self)

    def register_views(self) -> None:
        """Temporary views of all tables, for ``spark.sql``."""
        for name in READERS:
            self.read(name).createOrReplaceTempView(name)

    # -- logs

    def log(self, kind: str, status: str = "accepted") -> DataFrame:
        return self.read_stored(f"{kind}_log", kind).filter(F.col("status") == status)

    def live_transactions(self) -> DataFrame:
        """Accepted transactions that no committed archive run has taken."""
        rows = self.log("transactions")
        run = self.archive_run()
        if run is not None:
            cutoff, through = run
            later = F.col("batch_id") > through
            start = period_start(instant(cutoff), self.period)
            # The first filter follows from the second; it spares opening archived folders.
            rows = rows.filter((F.col(self.period_column) >= start) | later)
            rows = rows.filter((F.col("timestamp") >= instant(cutoff)) | later)
        return rows

    def archive_run(self) -> tuple[datetime, int] | None:
        """Cutoff and last batch of the newest committed archive run."""
        run = self.committed("archive")
        if run < 0:
            return None
        row = self.read_batch("archive_runs", run).select(
            F.date_format("cutoff", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("cutoff"),
            "through_batch",
        ).first()
        return datetime.strptime(row["cutoff"], "%Y-%m-%d %H:%M:%S.%f"), row["through_batch"]

    # -- current tables

    def _snapshot(self, name: str) -> str:
        return f"{self.root}/{name}_snapshot"

    def snapshot(self, name: str, through: int | None = None) -> DataFrame:
        """The rows of a compaction, the last by default, straight from its files."""
        if through is None:
            through = self.committed(f"{name}_snapshot")
        schema = CURRENT[name].changes(self, -1).schema
        if through < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self._snapshot(name)}/through={through}")

    def changes(self, name: str) -> DataFrame:
        """The last snapshot of a current table and the changes made since, not folded."""
        through = self.committed(f"{name}_snapshot")
        since = CURRENT[name].changes(self, through)
        return since if through < 0 else since.unionByName(self.snapshot(name, through))

    def current(self, name: str) -> DataFrame:
        return CURRENT[name].fold(self.changes(name))

    def running(self, dimension: str) -> DataFrame:
        """The newest all-time total of each key, as logged by the stateful stream."""
        keys = DIMENSIONS[dimension]
        rows = self.current(RUNNING).filter(F.col("dimension") == dimension)
        return rows.select(*keys, "quantity", "processed_at")

    def compact(self, name: str) -> None:
        """Publish the rows up to the last batch as a new snapshot, so reads stop there.

        The changes up to the previous snapshot and the snapshots before it are
        dropped; younger ones stay for readers that have started. Changes that come from
        a log stay in it.
        """
        snapshot = f"{name}_snapshot"
        last, previous = self.committed(CURRENT[name].stream), self.committed(snapshot)
        if last <= previous:
            return
        # A stream may commit meanwhile; its batch belongs to the next snapshot.
        rows = self.changes(name).filter(F.col("batch_id") <= last)
        folded = CURRENT[name].fold(rows)
        writer = folded.write.mode("overwrite").option("compression", COMPRESSION)
        writer.parquet(f"{self._snapshot(name)}/through={last}")
        self.commit(snapshot, last)
        for old in files.matches(self.spark, f"{self._snapshot(name)}/through=*"):
            if int(old.rpartition("=")[2]) < previous:
                files.delete(self.spark, old)
        own = CURRENT[name].own_table
        for folder in files.names(self.spark, self.path(own)) if own else ():
            number = folder.removeprefix("batch_id=")
            if number.isdigit() and int(number) <= previous:
                files.delete(self.spark, f"{self.path(own)}/{folder}")


@dataclass(frozen=True)
class _Current:
    """A table read as snapshot and changes, all with the ``batch_id`` they come from.

    ``changes`` gives those after a batch. ``fold`` brings rows to their final form and can
    be applied to folded rows again. ``own_table`` holds nothing but these changes, so
    compaction empties it.
    """

    changes: Callable[[Tables, int], DataFrame]
    fold: Callable[[DataFrame], DataFrame]
    own_table: str | None = None
    stream: str = "transactions"


def _keyed(table: str, key: str) -> _Current:
    values = [*(c for c in STORED[table].types if c != key), "batch_id"]
    return _Current(
        lambda tables, after: tables.read_stored(table, "transactions", after),
        lambda rows: latest(rows, [key], values, ["batch_id"]),
        table,
    )


def _city_changes(tables: Tables, after: int) -> DataFrame:
    rows = tables.read_stored("quantity_totals", "transactions", after)
    return rows.filter(F.col("dimension") == "city").select(
        "city",
        "state",
        F.col("quantity").alias("total_quantity"),
        F.col("processed_at").alias("last_updated"),
        "batch_id",
    )


def _city_sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy("city", "state").agg(
        F.sum("total_quantity").cast("bigint").alias("total_quantity"),
        F.max("last_updated").alias("last_updated"),
        F.max("batch_id").alias("batch_id"),
    )


def _batch_totals(tables: Tables) -> DataFrame:
    rows = tables.read_stored("quantity_totals", "transactions")
    return rows.filter(F.col("dimension").isin("category", "payment", "shipping")).select(
        "dimension", "category", "payment_method", "shipping_method", "quantity",
        "processed_at", "batch_id",
    )


def _newest_totals(rows: DataFrame) -> DataFrame:
    keys = ["dimension", *dict.fromkeys(k for keys in DIMENSIONS.values() for k in keys)]
    return latest(rows, keys, ["quantity", "processed_at", "batch_id"], ["batch_id"])


CURRENT: dict[str, _Current] = {
    "users": _keyed("user_changes", "user_id"),
    "products": _keyed("product_changes", "product_id"),
    "sales_per_city": _Current(_city_changes, _city_sum),
    RUNNING: _Current(
        lambda tables, after: tables.read_stored(RUNNING, RUNNING, after),
        _newest_totals,
        stream=RUNNING,
    ),
}


def _events(kind: str, keep: Sequence[str]) -> Callable[[Tables], DataFrame]:
    return lambda tables: tables.log(kind).select(
        *keep, "processed_at", tables.period_column
    )


def _rejects(tables: Tables) -> DataFrame:
    parts = [
        tables.log(kind, "rejected").select(
            F.lit(kind).alias("kind"), "value", "reject_reason", "processed_at", "batch_id"
        )
        for kind in ("transactions", "clickstream", "inventory")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _totals(tables: Tables, dimension: str) -> DataFrame:
    return _batch_totals(tables).filter(F.col("dimension") == dimension)


def _methods(dimension: str) -> Callable[[Tables], DataFrame]:
    """Values seen so far; ``last_updated`` is when a value was first stored."""
    (key,) = DIMENSIONS[dimension]
    return lambda tables: (
        _totals(tables, dimension).groupBy(key).agg(F.min("processed_at").alias("last_updated"))
    )


def _batches(dimension: str) -> Callable[[Tables], DataFrame]:
    (key,) = DIMENSIONS[dimension]
    return lambda tables: _totals(tables, dimension).select(
        "batch_id", key, "quantity", "processed_at"
    )


# Reports of live transactions leave out the name and the e-mail, which ``users`` has too.
TRANSACTION_COLUMNS = [
    c for c in columns("transactions") if c not in ("user_name", "user_email")
]

def _newest_reports(tables: Tables) -> DataFrame:
    """The row of each day that was published last."""
    values = [c for c in STORED["daily_reports"].types if c != "date"]
    rows = tables.read_stored("daily_reports", "daily_reports")
    return latest(rows, ["date"], values, ["batch_id"])


READERS: dict[str, Callable[[Tables], DataFrame]] = {
    "transaction_data": lambda tables: tables.live_transactions().select(
        *TRANSACTION_COLUMNS, "processed_at", tables.period_column
    ),
    "clickstream_logs": _events("clickstream", columns("clickstream")),
    "inventory_updates": _events("inventory", columns("inventory")),
    "rejects": _rejects,
    "batch_details": _batches("category"),
    "sales_by_payment": _batches("payment"),
    "sales_by_shipping": _batches("shipping"),
    "payment_methods": _methods("payment"),
    "shipping_methods": _methods("shipping"),
    "users": lambda tables: tables.current("users").drop("batch_id"),
    "products": lambda tables: tables.current("products").drop("batch_id"),
    "sales_per_city": lambda tables: tables.current("sales_per_city").drop("batch_id"),
    "us_coordinates": lambda tables: tables.read_stored(
        "coordinate_loads", "coordinates"
    ).drop("batch_id"),
    "archived_transaction_data": lambda tables: tables.read_stored(
        "archived_transactions", "archive"
    ).drop("batch_id"),
    "daily_summary": lambda tables: _newest_reports(tables).select(
        *(c for c in STORED["daily_reports"].types if c != "as_of")
    ),
    "alerts": lambda tables: tables.read_stored("alerts", "alerts").drop("batch_id"),
    "daily_keys": lambda tables: tables.read_stored("daily_keys", "transactions").drop(
        "batch_id", tables.period_column
    ),
    "stream_progress": lambda tables: tables.read_stored(
        "stream_progress", "stream_progress"
    ).drop("batch_id", tables.period_column),
    "stream_failures": lambda tables: tables.read_stored("stream_progress", "stream_progress")
    .filter(F.col("event") == "failed")
    .select("stream", "run_id", "error_class", "message", "at"),
    "coordinate_rejects": lambda tables: tables.read_stored(
        "coordinate_rejects", "coordinates"
    ),
}
