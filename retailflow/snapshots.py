"""Current tables over bucketed snapshots: folding shuffles the changes, not the snapshot.

A snapshot is a catalog table bucketed and sorted by the key, a file for each bucket. Joined with
the changes since on that key, it is read bucket by bucket as it is; only the changes move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retailflow import files
from retailflow.catalog import Catalog
from retailflow.tables import CURRENT

#: The tables with a single key, by which their snapshots are bucketed.
KEYS = {"users": "user_id", "products": "product_id"}


class Snapshots:
    """Bucketed snapshots of the current tables in ``catalog``.

    ``buckets`` is best the number of shuffle partitions or more: with fewer, Spark deals both
    sides of the join anew. A snapshot with another number is read and replaced all the same.
    """

    def __init__(self, catalog: Catalog, buckets: int):
        self.catalog, self.buckets = catalog, buckets
        self.tables, self.spark = catalog.tables, catalog.spark

    def _path(self, name: str, through: int, buckets: int | str) -> str:
        return f"{self.tables.root}/{name}_bucketed/through={through}/buckets={buckets}"

    def snapshot(self, name: str, through: int) -> DataFrame:
        """The snapshot as a table; created from its files where this process has none."""
        table = f"{name}_through_{through}"
        if not self.catalog.exists(table):
            (path,) = files.matches(self.spark, self._path(name, through, "*"))
            schema = CURRENT[name].changes(self.tables, -1).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            key, buckets = KEYS[name], path.rpartition("=")[2]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.catalog.name(table)} ({columns}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(self.catalog.name(table))

    def _folded(self, name: str, last: int | None = None) -> DataFrame:
        key, through = KEYS[name], self.tables.committed(f"{name}_bucketed")
        changes = CURRENT[name].changes(self.tables, through)
        if last is not None:
            changes = changes.filter(F.col("batch_id") <= last)
        changes = CURRENT[name].fold(changes)
        if through < 0:
            return changes
        # Every change is younger than the snapshot, so the newer side wins whole.
        old, new = self.snapshot(name, through).alias("old"), changes.alias("new")
        newer = F.col(f"new.{key}").isNotNull()
        return old.join(new, key, "full_outer").select(
            key,
            *[
                F.when(newer, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
                for c in changes.columns
                if c != key
            ],
        )

    def current(self, name: str) -> DataFrame:
        """The current rows, as :meth:`Tables.current` gives them."""
        return self._folded(name).drop("batch_id")

    def compact(self, name: str) -> None:
        """Publish the rows up to the last batch as a new bucketed snapshot.

        Snapshots before the last one are dropped; the last stays for readers that have started.
        The change log stays: it is :meth:`Tables.compact` that empties it.
        """
        stream, marker = CURRENT[name].stream, f"{name}_bucketed"
        last, previous = self.tables.committed(stream), self.tables.committed(marker)
        if last <= previous:
            return
        key, path = KEYS[name], self._path(name, last, self.buckets)
        table = self.catalog.name(f"{name}_through_{last}")
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # of a run that failed
        files.delete(self.spark, path)
        (
            self._folded(name, last)
            .repartition(self.buckets, key)  # a file for each bucket
            .write.bucketBy(self.buckets, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(table)
        )
        self.tables.commit(marker, last)
        root = f"{self.tables.root}/{name}_bucketed"
        for folder in files.names(self.spark, root):
            number = int(folder.rpartition("=")[2])
            if number < previous:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog.name(f'{name}_through_{number}')}")
                files.delete(self.spark, f"{root}/{folder}")
