"""Point-in-time helpers; ``as_of`` is always an argument, never the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

RETENTION = timedelta(days=30)

# The partition column of a log, by the length of the period one folder covers.
PERIODS = {"day": "event_date", "month": "event_month", "year": "event_year"}


def in_utc(as_of: datetime) -> datetime:
    """The same instant in UTC; a time without a zone is taken to be UTC."""
    if as_of.tzinfo is None:
        return as_of.replace(tzinfo=timezone.utc)
    return as_of.astimezone(timezone.utc)


def instant(as_of: datetime) -> Column:
    """A literal that means the same instant whatever zone the driver runs in."""
    return F.lit(in_utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def day_start(as_of: datetime) -> Column:
    return F.date_trunc("DAY", instant(as_of))


def period_start(time: Column, period: str) -> Column:
    """The date a log's folder is named after."""
    return F.to_date(F.date_trunc(period, time))


def period_end(start: date, period: str) -> date:
    """The first day after the folder's period."""
    if period == "day":
        return start + timedelta(days=1)
    if period == "month":
        return (start.replace(day=1) + timedelta(days=32)).replace(day=1)
    return start.replace(year=start.year + 1)


def since_today(df: DataFrame, as_of: datetime, time_column: str = "timestamp") -> DataFrame:
    """Rows from the start of the ``as_of`` day on, later days included.

    Spark does not derive the folder predicate from the time predicate, so rows of a
    log partitioned by period get both.
    """
    start = day_start(as_of)
    kept = df.filter(F.col(time_column) >= start)
    if time_column == "timestamp":
        for period, column in _partitions(df):
            kept = kept.filter(F.col(column) >= period_start(start, period))
    return kept


def older_than(df: DataFrame, cutoff: Column) -> DataFrame:
    """Rows strictly before ``cutoff``."""
    kept = df.filter(F.col("timestamp") < cutoff)
    for period, column in _partitions(df):
        kept = kept.filter(F.col(column) <= period_start(cutoff, period))
    return kept


def _partitions(df: DataFrame) -> list[tuple[str, str]]:
    return [(period, column) for period, column in PERIODS.items() if column in df.columns]


def archive_cutoff(as_of: datetime, retention: timedelta = RETENTION) -> datetime:
    return in_utc(as_of) - retention
