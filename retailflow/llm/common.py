"""What the operators share: stored steps, row identities and vocabulary files."""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailflow.session import scratch_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back.

    A join of two stored tables, or of one with rows as they are shuffled, is one whose hot
    keys Spark splits; beside an aggregation of its own input it keeps a key in one task.

    Cuts the lineage at files that outlive any executor, and freezes what depends on the
    order of rows in a task, such as row numbers. The caller's session deletes nothing:
    the returned frame is lazy and reads these files when it runs.
    """
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows`` as a reliable checkpoint, for copies of whole documents.

    As lasting as :func:`stored`, but Spark deletes it when no result refers to it any more
    (``spark.cleaner.referenceTracking.cleanCheckpoints``), so the stages of a pipeline do not
    pile up copies of the corpus.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(rows.sparkSession, "checkpoints"))
    return rows.checkpoint()


def row_number() -> Column:
    """A number for each row that is its own until the rows are computed again: store them."""
    return F.monotonically_increasing_id()


def bloom_filter(keys: DataFrame, bits: int) -> bytes:
    """A Bloom filter of 2 ** ``bits`` bits over the one column of ``keys``, 64-bit hashes.

    Gathered on the executors; the driver and whoever it is broadcast to hold 2 ** bits bits,
    whatever the number of keys. :func:`bloom_hits` asks it.
    """
    import numpy as np

    (name,) = keys.columns
    key = F.col(name)
    low = key.bitwiseAND(F.lit((1 << bits) - 1))
    places = F.array(low, F.shiftrightunsigned(key, 64 - bits))
    pieces = (
        keys.select(F.explode(places).alias("at"))
        .select((F.col("at") + 1).alias("at"))  # buckets count from 1
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    width = 4096  # bytes of a bucket
    bitmap = np.zeros((1 << bits) // 8 + width, dtype=np.uint8)
    for row in pieces.collect():
        start = (row["bucket"] - 1) * width
        bitmap[start : start + width] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bitmap.tobytes()


def bloom_hits(bitmap, bits: int, keys):
    """The places in ``keys`` (unsigned) of those the filter lets through."""
    import numpy as np

    def hit(at):
        return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    kept = np.flatnonzero(hit(keys & np.uint64((1 << bits) - 1)))
    return kept[hit(keys[kept] >> np.uint64(64 - bits))]


@functools.cache  # a worker serves many tasks
def tokenizer(path: str):
    """The tokenizer of a .json file, single-threaded, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine it is installed on."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
