"""Reports at their edges."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import events, found

from retailflow.functions.timing import archive_cutoff, instant, older_than, since_today
from retailflow.plans import reports
from retailflow.plans.scheduled import export_daily_summary, load_coordinates

DAY = datetime(2024, 3, 1)
AS_OF = datetime(2024, 3, 1, 15, 30)


def at(*args, **changes):
    return {"timestamp": datetime(*args), **changes}


def test_today_starts_at_midnight_and_has_no_end(spark):
    rows = events(
        spark,
        at(2024, 2, 29, 23, 59, 59, 999999),
        at(2024, 3, 1),
        at(2024, 3, 1, 16),
        at(2025, 1, 1),
    )
    kept = found(since_today(rows, AS_OF), "timestamp")
    assert kept == [(datetime(2024, 3, 1),), (datetime(2024, 3, 1, 16),), (datetime(2025, 1, 1),)]


def test_cutoff_is_strict(spark):
    rows = events(spark, at(2024, 1, 31, 15, 29, 59), at(2024, 1, 31, 15, 30))
    cutoff = instant(archive_cutoff(AS_OF))
    assert found(older_than(rows, cutoff), "timestamp") == [(datetime(2024, 1, 31, 15, 29, 59),)]


def test_daily_summary(spark):
    rows = events(
        spark,
        at(2024, 3, 1, order_id="a", quantity=2, price=1.25),
        at(2024, 3, 1, order_id="a", quantity=1, price=10),
        at(2024, 3, 2, order_id="b", quantity=3, price=0.1, user_id="u2"),
        at(2024, 2, 1, order_id="c"),
    )
    assert found(reports.daily_summary(rows, AS_OF)) == [
        (date(2024, 3, 1), 2, 6, Decimal("12.80"), 2)
    ]


def test_daily_summary_of_nothing_keeps_nulls(spark):
    summary = reports.daily_summary(events(spark, at(2020, 1, 1)), AS_OF)
    assert found(summary) == [(date(2024, 3, 1), 0, None, None, 0)]
    assert found(reports.export_row(summary)) == [("2024-03-01", 0, None, None, 0)]


def test_revenue_beyond_float_is_exact(spark):
    rows = events(
        spark, *[at(2024, 3, 1, quantity=2**31 - 1, price="99999999.99") for _ in range(3)]
    )
    (row,) = reports.daily_summary(rows, AS_OF).collect()
    assert row["total_revenue"] == 3 * (2**31 - 1) * Decimal("99999999.99")


def test_counts_and_message(spark):
    rows = events(spark, at(2024, 3, 1), at(2024, 3, 1, user_id="u2"), at(2024, 2, 1))
    users = rows.select("user_id", F.col("timestamp").alias("last_updated"))
    assert found(reports.orders_today(rows, AS_OF)) == [(2,)]
    assert found(reports.users_active_today(users, AS_OF)) == [(2,)]
    assert found(reports.activity_message(rows, users, AS_OF)) == [
        (
            "Hourly Activity Update",
            "New total orders today: 2 <br> New user registrations today: 2",
        )
    ]


def test_message_of_nothing(spark):
    rows = events(spark, {}).limit(0)
    users = rows.select("user_id", F.col("timestamp").alias("last_updated"))
    (row,) = reports.activity_message(rows, users, AS_OF).collect()
    assert row["body"] == "New total orders today: 0 <br> New user registrations today: 0"


def test_large_orders_are_over_the_threshold(spark):
    rows = events(spark, at(2024, 3, 1, quantity=100), at(2024, 3, 1, quantity=101))
    assert found(reports.large_orders(rows, AS_OF), "quantity") == [(101,)]


def test_alert_text(spark, folder):
    rows = events(
        spark,
        at(2024, 3, 1, 9, 0, 0, 120000, order_id="b", quantity=200),
        at(2024, 3, 1, 8, order_id="a", quantity=150),
    )
    alert = reports.large_order_alert(reports.large_orders(rows, AS_OF), folder)
    assert found(alert) == [
        (
            0,
            "Order ID: a, User ID: u1, Quantity: 150, Time: 2024-03-01 08:00:00<br>"
            "Order ID: b, User ID: u1, Quantity: 200, Time: 2024-03-01 09:00:00.120000",
            True,
        )
    ]


def test_alert_of_nothing(spark, folder):
    alert = reports.large_order_alert(events(spark, {}).limit(0), folder)
    assert found(alert) == [(0, "No suspicious orders detected today.", False)]


def test_alert_parts_hold_every_line(spark, folder):
    orders = spark.range(10_000).select(
        F.lit("hot").alias("order_id"),
        F.lit("u").alias("user_id"),
        F.lit(500).alias("quantity"),
        F.lit(DAY).alias("timestamp"),
    )
    parts = reports.large_order_alert(orders, folder, lines_per_message=999).collect()
    sizes = [len(row["body"].split("<br>")) for row in sorted(parts, key=lambda r: r["part"])]
    assert sizes == [999] * 10 + [10]


def test_export_replaces_the_day(spark, tables):
    rows = events(spark, at(2024, 3, 1), at(2024, 3, 2, order_id="b"))
    for _ in range(2):
        export_daily_summary(tables, rows, AS_OF)
    export_daily_summary(tables, rows, datetime(2024, 3, 2))
    assert found(tables.read("daily_summary")) == [
        ("2024-03-01", 2, 4, 50.0, 1),
        ("2024-03-02", 1, 2, 25.0, 1),
    ]


def test_export_day_is_the_utc_day(spark, tables):
    bangkok = timezone(timedelta(hours=7))
    stored = export_daily_summary(
        tables, events(spark, at(2024, 3, 1)), datetime(2024, 3, 2, 3, tzinfo=bangkok)
    )
    assert found(stored, "date", "orders") == [("2024-03-01", 1)]


def test_coordinates_load_once(spark, tables, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("city,state,latitude,longitude\nA,TX,1,1\nA,TX,2,2\nB,TX,3,3\n")
    assert load_coordinates(tables, str(path)) == 2
    assert load_coordinates(tables, str(path)) == 0
    path.write_text("city,state,latitude,longitude\nA,TX,9,9\nC,TX,4,4\n")
    assert load_coordinates(tables, str(path)) == 1
    rows = found(tables.read("us_coordinates"), "city", "latitude")
    assert rows == [("A", Decimal(1)), ("B", Decimal(3)), ("C", Decimal(4))]


def test_city_without_coordinates_stays(spark):
    totals = spark.createDataFrame([("A", "TX", 5), ("B", "TX", 6)], "city string, state string, q int")
    known = spark.createDataFrame([("A", "TX", 1.0)], "city string, state string, latitude double")
    assert found(reports.city_sales_geo(totals, known)) == [("A", "TX", 5, 1.0), ("B", "TX", 6, None)]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh"])
def test_as_of_is_an_instant_in_utc(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = spark.range(1).select(F.unix_timestamp(instant(AS_OF))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == 1709307000
