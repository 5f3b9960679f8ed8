"""The scheduled reports, each for an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.functions.timing import day_start, since_today
from retailflow.operators.numbering import numbered

# The alert threshold and the texts of the two messages.
LARGE_ORDER = 100
ACTIVITY_SUBJECT = "Hourly Activity Update"
ACTIVITY_BODY = "New total orders today: %d <br> New user registrations today: %d"
ALERT_LINE = "Order ID: %s, User ID: %s, Quantity: %d, Time: %s"
NOTHING_FOUND = "No suspicious orders detected today."

LINES_PER_MESSAGE = 1000


def daily_summary(transactions: DataFrame, as_of: datetime) -> DataFrame:
    """One row: date, orders, total_quantity, total_revenue, users."""
    revenue = F.col("price") * F.col("quantity")
    return (
        since_today(transactions, as_of)
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").cast("bigint").alias("total_quantity"),
            F.sum(revenue).cast("decimal(31,2)").alias("total_revenue"),
            F.count_distinct("user_id").alias("users"),
        )
        .select(
            F.to_date(day_start(as_of)).alias("date"),
            "orders",
            "total_quantity",
            "total_revenue",
            "users",
        )
    )


def daily_summary_merged(keys: DataFrame, as_of: datetime) -> DataFrame:
    """The row of :func:`daily_summary` from the keys and sums stored with each batch.

    A key that many batches hold counts once: the union of the batches is exact. What is
    shuffled are the batches' different keys, not the day's rows, and nothing is expanded.
    All rows logged count, whether or not the archive has taken them.
    """
    recent = keys.filter(F.col("day") >= F.to_date(day_start(as_of)))
    different = recent.groupBy("kind", "key").agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )
    return different.agg(
        F.count_if(F.col("kind") == "orders").alias("orders"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("revenue").cast("decimal(31,2)").alias("total_revenue"),
        F.count_if(F.col("kind") == "users").alias("users"),
    ).select(
        F.to_date(day_start(as_of)).alias("date"),
        "orders",
        "total_quantity",
        "total_revenue",
        "users",
    )


def export_row(summary: DataFrame) -> DataFrame:
    """The summary in the types a spreadsheet takes: date as text, revenue as float."""
    return summary.withColumns(
        {
            "date": F.col("date").cast("string"),
            "total_revenue": F.col("total_revenue").cast("double"),
        }
    )


def orders_today(transactions: DataFrame, as_of: datetime) -> DataFrame:
    """Transaction rows since the start of the day."""
    return since_today(transactions, as_of).agg(F.count(F.lit(1)).alias("orders"))


def users_active_today(users: DataFrame, as_of: datetime) -> DataFrame:
    """Users written since the start of the day, from the table or its change log.

    A user is active if any change is recent, so the log gives the same count as
    the folded table while only its recent changes are read.
    """
    recent = since_today(users, as_of, "last_updated")
    return recent.agg(F.count_distinct("user_id").alias("users"))


def activity_message(transactions: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    """One row: subject and body of the activity message."""
    counts = (
        orders_today(transactions, as_of)
        .select("orders", F.lit(None).cast("bigint").alias("users"))
        .unionByName(
            users_active_today(users, as_of).select(
                F.lit(None).cast("bigint").alias("orders"), "users"
            )
        )
    )
    return counts.agg(F.max("orders").alias("orders"), F.max("users").alias("users")).select(
        F.lit(ACTIVITY_SUBJECT).alias("subject"),
        F.format_string(ACTIVITY_BODY, "orders", "users").alias("body"),
    )


def large_orders(
    transactions: DataFrame, as_of: datetime, threshold: int = LARGE_ORDER
) -> DataFrame:
    """Transactions since the start of the day with more than ``threshold`` pieces."""
    return (
        since_today(transactions, as_of)
        .filter(F.col("quantity") > threshold)
        .select("order_id", "user_id", "quantity", "timestamp")
    )


def large_order_alert(
    orders: DataFrame, folder: str, lines_per_message: int = LINES_PER_MESSAGE
) -> DataFrame:
    """Alert messages (part, body, found) naming every large order, in time order.

    A message holds at most ``lines_per_message`` lines, so no task ever builds an
    unbounded text; more orders make more parts. Without orders there is one part
    saying so. ``folder`` is a scratch path for the sorted rows.
    """
    line = F.format_string(
        ALERT_LINE, "order_id", "user_id", "quantity", _time_text("timestamp")
    )
    lines = numbered(orders, ["timestamp", "order_id", "user_id", "quantity"], folder)
    nothing = (
        lines.agg(F.count(F.lit(1)).alias("orders"))
        .filter("orders = 0")
        .select(
            F.lit(0).cast("bigint").alias("part"),
            F.lit(NOTHING_FOUND).alias("body"),
            F.lit(False).alias("found"),
        )
    )
    part = F.floor(F.col("n") / lines_per_message).cast("bigint")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"])
    return (
        lines.select(part.alias("part"), "n", line.alias("line"))
        .groupBy("part")
        .agg(F.array_join(texts, "<br>").alias("body"))
        .select("part", "body", F.lit(True).alias("found"))
        .unionByName(nothing)
    )


def _time_text(column: str) -> Column:
    """Date and time, with six decimals only where there is a fraction of a second."""
    whole = F.date_trunc("SECOND", column) == F.col(column)
    return F.when(whole, F.date_format(column, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def city_sales_geo(city_totals: DataFrame, coordinates: DataFrame) -> DataFrame:
    """City totals with latitude and longitude, NULL where the city is not known.

    Both sides have one row per city; Spark broadcasts the lookup if its measured
    size allows.
    """
    return city_totals.join(coordinates, ["city", "state"], "left")
