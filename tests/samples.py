"""Small hand-made events."""

from __future__ import annotations

import json
from datetime import datetime

from retailflow.schemas import columns

ORDER = {
    "order_id": "o1",
    "user_id": "u1",
    "user_name": "Ann",
    "user_email": "ann@example.com",
    "street": "1 Main St",
    "city": "Austin",
    "state": "TX",
    "postal_code": "73301",
    "country": "United States",
    "product_id": "p1",
    "category": "Books",
    "price": 12.5,
    "quantity": 2,
    "shipping_method": "Free",
    "payment_method": "PayPal",
    "timestamp": "2024-03-01T08:00:00.000000+00:00",
}

CLICK = {
    "event_id": "e1",
    "user_id": "u1",
    "page_url": "/home",
    "action": "view",
    "timestamp": "2024-03-01T08:00:00+00:00",
}

STOCK = {
    "event_id": "e1",
    "product_id": "p1",
    "change_type": "sold",
    "quantity_change": 3,
    "timestamp": "2024-03-01T08:00:00+00:00",
}

SAMPLE = {"transactions": ORDER, "clickstream": CLICK, "inventory": STOCK}


def order(**changes) -> str:
    return json.dumps({**ORDER, **changes})


def raw(spark, values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def events(spark, *changes):
    """Typed transaction rows, each the sample order with some fields changed."""
    from decimal import Decimal

    from retailflow.schemas import STORED

    layout = STORED["transactions_log"].types
    names = columns("transactions")
    rows = []
    for change in changes:
        row = {**ORDER, "timestamp": datetime(2024, 3, 1, 8), **change}
        if row["price"] is not None:
            row["price"] = Decimal(str(row["price"]))
        rows.append(tuple(row[name] for name in names))
    ddl = ", ".join(f"`{name}` {layout[name]}" for name in names)
    return spark.createDataFrame(rows, ddl)


def found(df, *names):
    """Rows as a sorted list of plain tuples."""
    rows = [tuple(row) for row in df.select(*(names or df.columns)).collect()]
    return sorted(rows, key=repr)
