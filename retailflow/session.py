"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The default type has no statistics, so filters on times would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# State outside the heap, committed as the changes of a batch, not as whole files.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# What a task reads of a shuffle, unless the session says. JSON costs much for its bytes: with
# Spark's 64 MB, a stage of a few more parts than cores takes twice as long as its work.
PART, SMALL_PART = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators assume; cluster sizing is left alone."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(PART, None) is None:
        spark.conf.set(PART, SMALL_PART)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str, instead: str | None = None) -> Iterator[None]:
    """Within the block, ``name`` is ``value``: always, or only where it would be ``instead``."""
    former = spark.conf.get(name, None)
    if instead is not None and former != instead:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if former is None else spark.conf.set(name, former)


def sized_files(spark: SparkSession):
    """Within the block, what is shuffled to make files is cut into parts of 64 MB."""
    return setting(spark, PART, "64m", instead=SMALL_PART)


def stateful_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session for stateful streams: RocksDB state and a fixed partition count.

    The count is frozen into a checkpoint on first start, so it is an argument and
    does not follow whatever the caller's session happens to use.
    """
    session = configure(spark.newSession())
    for key, value in STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster shares through spark.checkpoint.dir.

    Only a local master may go without that setting: every task then runs on this
    machine, so a temporary folder is visible to all of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/retailflow/{name}-{uuid.uuid4().hex}"


_local: list[str] = []


def _local_folder() -> str:
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="retailflow-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]
