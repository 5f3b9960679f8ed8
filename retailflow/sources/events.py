"""Raw records, one ``value`` column, from a broker topic or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailflow.schemas import TOPICS

FILE_FORMATS = ("text", "parquet")

# A stream forgets files this much older than the newest one it has seen, and would skip one
# that lands later. Spark's week loses a backlog, so the default outlasts any.
MAX_FILE_AGE = "36500d"


def kafka_options(kind: str, servers: str, topic: str | None = None, **options: str) -> dict:
    """From the earliest offset, and not failing when the broker dropped old records."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic or TOPICS[kind],
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **options,
    }


def read_topic(
    spark: SparkSession,
    kind: str,
    servers: str,
    topic: str | None = None,
    stream: bool = True,
    **options: str,
) -> DataFrame:
    """Needs the spark-sql-kafka package on the cluster's class path."""
    reader = spark.readStream if stream else spark.read
    settings = kafka_options(kind, servers, topic, **options)
    return reader.format("kafka").options(**settings).load().select("value")


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    stream: bool = True,
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """One JSON record per text line, or a ``value`` column of Parquet files.

    On a stream, ``path`` may be a pattern such as ``landing/*`` and
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a batch. Files of finished batches
    move to the folder ``archive``, on the same file system and outside ``path``, so what a
    batch lists does not grow with what has been read; no other stream may read ``path`` then,
    it would miss them. No file is too old to be read
    (``maxFileAge``), so the stream remembers the names of all it has read; give a
    ``maxFileAge`` longer than any backlog to bound that list.
    """
    if fmt not in FILE_FORMATS:
        raise ValueError(f"format must be one of {FILE_FORMATS}, not {fmt!r}")
    reader = spark.readStream if stream else spark.read
    if stream:
        options.setdefault("maxFileAge", MAX_FILE_AGE)
        if archive:
            options.update(cleanSource="archive", sourceArchiveDir=archive)
    return reader.format(fmt).schema("value string").options(**options).load(path)
