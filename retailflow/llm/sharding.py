"""Sharding by proportional stratified interleaving (operator 7).

Each source's rows are shuffled by a seeded hash. Row r of a source with n rows gets the
fractional rank (r + 1/2) / n, all rows are put in order of it, and the order is cut into
shards of equal row counts: every stretch of it holds each source in proportion.

Both orders are global sorts whose tasks number their own rows, so a source with a third of
all rows is spread over the tasks like any other. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retailflow.llm.common import stored
from retailflow.operators.numbering import numbered
from retailflow.session import scratch_folder

SHARDS, SEED = 40, 42


def interleave(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, source: str = "source"
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``source``, ``size`` (UTF-8 bytes of the text and
    16), ``text_crc32``, ``shard``, ``slot`` (from 0 without gaps in its shard).

    The law is ``rows``: shards differ by one row at most. Null sources are one source, null
    texts have no bytes. Rows that are alike in all of this are interchangeable, so repeated
    rows and null doc_ids get slots of their own. Further columns are ignored; an empty table
    gives an empty result.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("shuffled", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    spark = docs.sparkSession
    ranked = numbered(
        rows, ["source", "shuffled", "doc_id"], scratch_folder(spark, "shard-sources"), "n"
    )
    ranked = stored(ranked, "shard-ranks")
    sizes = ranked.groupBy(F.col("source").alias("of")).agg(
        F.min("n").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    sizes = stored(sizes, "shard-sizes")
    places = ranked.join(sizes, F.col("source").eqNullSafe(F.col("of"))).select(
        "source",
        "doc_id",
        "size",
        "text_crc32",
        "shuffled",
        ((F.col("n") - F.col("first") + 0.5) / F.col("rows")).alias("rank"),
    )
    ordered = numbered(
        places, ["rank", "source", "shuffled", "doc_id"], scratch_folder(spark, "shard-order"), "n"
    )
    total = max(1, ranked.count())
    shard = F.expr(f"n * {shards} div {total}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "shard",
        (F.col("n") - first).cast("long").alias("slot"),
    )
