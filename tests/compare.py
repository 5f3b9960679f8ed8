"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return database


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def differences(spark, database, query, sql: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL: names, row count, then rows."""
    frame = query(spark, sf_dir)
    cursor = database.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    found = rows(frame.columns, [tuple(row) for row in frame.collect()])
    wanted = rows(names, cursor.fetchall())
    extra, missing = found - wanted, wanted - found
    if not extra and not missing:
        return []
    return [
        f"rows {sum(found.values())} against {sum(wanted.values())}",
        f"extra {list(extra)[:2]}",
        f"missing {list(missing)[:2]}",
    ]


def timed(action):
    start = time.monotonic()
    return action(), time.monotonic() - start
