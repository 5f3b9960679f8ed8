"""Keyed tables: one current row per key, and the values seen in a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

USER = ("user_id", "user_name", "user_email")
PRODUCT = ("product_id", "category", "price")


def distinct_users(events: DataFrame) -> DataFrame:
    return events.select(*USER).distinct()


def distinct_products(events: DataFrame) -> DataFrame:
    return events.select(*PRODUCT).distinct()


def latest(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key, the ``values`` of the row that is greatest by ``order``, then by values.

    ``max`` of a struct combines per task before the shuffle, unlike a ranking
    window, so a key holding a third of the rows ships one row per task.
    """
    picked = F.max(F.struct(*dict.fromkeys([*order, *values])))
    return df.groupBy(*keys).agg(picked.alias("_last")).select(
        *keys, *[F.col("_last").getField(c).alias(c) for c in values]
    )


def latest_users(events: DataFrame, updated: Column) -> DataFrame:
    """Users of a batch: greatest (timestamp, order_id, all columns) wins."""
    rows = events.select(*USER, "timestamp", "order_id", updated.alias("last_updated"))
    return latest(
        rows, ["user_id"], ["user_name", "user_email", "last_updated"], ["timestamp", "order_id"]
    )


def latest_products(events: DataFrame, updated: Column) -> DataFrame:
    """Products of a batch: greatest (timestamp, order_id, all columns) wins."""
    rows = events.select(*PRODUCT, "timestamp", "order_id", updated.alias("last_updated"))
    return latest(
        rows, ["product_id"], ["category", "price", "last_updated"], ["timestamp", "order_id"]
    )
