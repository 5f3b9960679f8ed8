"""Quantity totals by category, city, payment method and shipping method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.schemas import DIMENSIONS

KEY_COLUMNS = [key for keys in DIMENSIONS.values() for key in keys]


def quantity_by(events: DataFrame, dimension: str) -> DataFrame:
    """Summed quantity per key: of a batch, or running when ``events`` is a stream."""
    return events.groupBy(*DIMENSIONS[dimension]).agg(
        F.sum("quantity").cast("bigint").alias("quantity")
    )


def grouping_bits(dimension: str) -> int:
    """What grouping_id says of a dimension: a bit, first column highest, for every column
    left out."""
    keys = DIMENSIONS[dimension]
    return int("".join("0" if column in keys else "1" for column in KEY_COLUMNS), 2)


def quantity_totals(events: DataFrame) -> DataFrame:
    """All four totals from one scan and one shuffle, told apart by ``dimension``.

    Key columns outside a row's dimension are NULL. Rows are combined per task
    before the shuffle, so a hot key costs one row per task.
    """
    names = {grouping_bits(name): name for name in DIMENSIONS}
    grouped = events.groupingSets(
        [list(keys) for keys in DIMENSIONS.values()], *KEY_COLUMNS
    ).agg(
        F.sum("quantity").cast("bigint").alias("quantity"), F.grouping_id().alias("_grouping")
    )
    dimension = F.coalesce(
        *[F.when(F.col("_grouping") == bits, F.lit(name)) for bits, name in names.items()]
    )
    return grouped.select(dimension.alias("dimension"), *KEY_COLUMNS, "quantity")


def daily_keys(events: DataFrame) -> DataFrame:
    """What a day's report needs of a batch: its different orders and users, and its sums.

    Rows of ``kind`` orders and users hold a ``key`` each, rows of kind sums the ``quantity``
    and ``revenue`` of all events of the day. One scan and one shuffle; keys are combined per
    task before it, and carry no sums through it.
    """
    day = F.to_date("timestamp").alias("day")
    none = F.lit(None)

    def part(kind: str, key: Column, quantity: Column = none, revenue: Column = none) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            key.cast("string").alias("key"),
            quantity.cast("bigint").alias("quantity"),
            revenue.cast("decimal(21,2)").alias("revenue"),
        )

    parts = F.array(
        part("orders", F.col("order_id")),
        part("users", F.col("user_id")),
        part("sums", none, F.col("quantity"), F.col("price") * F.col("quantity")),
    )
    return events.select(day, F.inline(parts)).groupBy("kind", "day", "key").agg(
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("revenue").cast("decimal(31,2)").alias("revenue"),
    )
