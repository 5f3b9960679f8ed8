"""The city coordinates file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header naming city, state, latitude and longitude, in any order.

    ``line`` orders the rows as they stand in the file (then by file name), across
    the splits Spark reads it in: blocks by offset, rows by position in the block.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select("city", "state", "latitude", "longitude", position.alias("line"))


# The types of the stored coordinates.
NUMBERS = {"latitude": "decimal(10,8)", "longitude": "decimal(11,8)"}


def _reasons() -> Column:
    """All that is wrong with a row, comma-joined; empty if nothing is."""
    missing = [F.when(F.col(c).isNull(), f"missing:{c}") for c in ("city", "state", *NUMBERS)]
    invalid = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), f"invalid:{c}")
        for c, t in NUMBERS.items()
    ]
    return F.concat_ws(",", *missing, *invalid)


def usable_coordinates(rows: DataFrame) -> DataFrame:
    """Rows with all four values, typed; the rest cannot be stored."""
    typed = {c: F.col(c).try_cast(t) for c, t in NUMBERS.items()}
    return rows.filter(_reasons() == "").withColumns(typed)


def rejected_coordinates(rows: DataFrame) -> DataFrame:
    """The other rows as they stand in the file, with ``reject_reason``."""
    reason = _reasons()
    columns = ["city", "state", "latitude", "longitude"]
    return rows.filter(reason != "").select(*columns, reason.alias("reject_reason"))
