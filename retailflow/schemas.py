"""Event fields with their constraints, and the layout of every stored table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = True
    max_length: int | None = None


# Field names, types, NOT NULL and length limits of the three events.
EVENTS: dict[str, tuple[Field, ...]] = {
    "transactions": (
        Field("order_id", max_length=255),
        Field("user_id", max_length=255),
        Field("user_name", max_length=255),
        Field("user_email", max_length=255),
        Field("street", max_length=500),
        Field("city", max_length=255),
        Field("state", max_length=255),
        Field("postal_code", max_length=20),
        Field("country", max_length=255),
        Field("product_id", max_length=255),
        Field("category", max_length=255),
        Field("price", "decimal(10,2)"),
        Field("quantity", "int"),
        Field("shipping_method", max_length=100),
        Field("payment_method", max_length=100),
        Field("timestamp", "timestamp"),
    ),
    "clickstream": (
        Field("event_id", max_length=255),
        Field("user_id", required=False, max_length=255),
        Field("page_url", required=False, max_length=50),
        Field("action", required=False, max_length=50),
        Field("timestamp", "timestamp", required=False),
    ),
    "inventory": (
        Field("event_id", max_length=255),
        Field("product_id", max_length=255),
        Field("change_type", max_length=50),
        Field("quantity_change", "int"),
        Field("timestamp", "timestamp", required=False),
    ),
}

# The topic each event kind arrives on.
TOPICS = {
    "transactions": "ecommerce-transactions",
    "clickstream": "clickstream-logs",
    "inventory": "inventory-updates",
}


def columns(kind: str) -> list[str]:
    return [field.name for field in EVENTS[kind]]


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(10,8)": T.DecimalType(10, 8),
    "decimal(11,8)": T.DecimalType(11, 8),
    "decimal(31,2)": T.DecimalType(31, 2),
    "variant": T.VariantType(),
}

# The number types of event fields, with the JSON values each is read from: whole numbers for
# int; any number, or its text, for a price.
NUMBERS = {"int": "^BIGINT", "decimal(10,2)": "^(BIGINT|DECIMAL|DOUBLE|STRING)"}


def _struct(types: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in types.items()])


def event_types(kind: str) -> dict[str, str]:
    return {field.name: field.type for field in EVENTS[kind]}


def json_schema(kind: str) -> T.StructType:
    """What from_json reads: times stay text, and numbers whatever JSON value they are.

    Both are cast later, with a null on failure, so that a value of the wrong type is told
    from one that is not there.
    """
    raw = {"timestamp": "string"} | dict.fromkeys(NUMBERS, "variant")
    return _struct({n: raw.get(t, t) for n, t in event_types(kind).items()})


# The keys of the four quantity totals.
DIMENSIONS: dict[str, tuple[str, ...]] = {
    "category": ("category",),
    "city": ("city", "state"),
    "payment": ("payment_method",),
    "shipping": ("shipping_method",),
}


# Stands for the period column the tables folder was created with.
PERIOD = "period"


@dataclass(frozen=True)
class Layout:
    """Columns of one stored table; ``partitions`` follow ``batch_id`` in the path."""

    types: dict[str, str]
    partitions: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return _struct(self.types)

    def by(self, column: str) -> Layout:
        """The layout with ``column`` as its period column."""
        return replace(
            self, partitions=tuple(column if p == PERIOD else p for p in self.partitions)
        )

    @property
    def gathered_schema(self) -> T.StructType:
        """As ``read_schema``, for folders that hold many batches: ``batch_id`` is data."""
        parts = {p: PARTITION_TYPES.get(p, "date") for p in (*self.partitions, "through")}
        return _struct({**self.types, "batch_id": "bigint", **parts})

    @property
    def read_schema(self) -> T.StructType:
        """Data columns plus the partition columns found in the path."""
        parts = {p: PARTITION_TYPES.get(p, "date") for p in ("batch_id", *self.partitions)}
        return _struct({**self.types, **parts})


PARTITION_TYPES = {
    "batch_id": "bigint",
    "status": "string",
    "dimension": "string",
    "kind": "string",
    "event": "string",
    "through": "bigint",
}

_TOTAL = {"quantity": "bigint", "processed_at": "timestamp"}

STORED: dict[str, Layout] = {
    **{
        f"{kind}_log": Layout(
            {
                **event_types(kind),
                "value": "string",
                "reject_reason": "string",
                "processed_at": "timestamp",
            },
            ("status", PERIOD),
        )
        for kind in EVENTS
    },
    "quantity_totals": Layout(
        {**{key: "string" for keys in DIMENSIONS.values() for key in keys}, **_TOTAL},
        ("dimension", PERIOD),
    ),
    "running_totals": Layout(
        {**{key: "string" for keys in DIMENSIONS.values() for key in keys}, **_TOTAL},
        ("dimension", PERIOD),
    ),
    "user_changes": Layout(
        {
            "user_id": "string",
            "user_name": "string",
            "user_email": "string",
            "last_updated": "timestamp",
        }
    ),
    "product_changes": Layout(
        {
            "product_id": "string",
            "category": "string",
            "price": "decimal(10,2)",
            "last_updated": "timestamp",
        }
    ),
    "coordinate_loads": Layout(
        {
            "city": "string",
            "state": "string",
            "latitude": "decimal(10,8)",
            "longitude": "decimal(11,8)",
        }
    ),
    "coordinate_rejects": Layout(
        {
            "city": "string",
            "state": "string",
            "latitude": "string",
            "longitude": "string",
            "reject_reason": "string",
        }
    ),
    "alerts": Layout(
        {"as_of": "timestamp", "part": "bigint", "body": "string", "found": "boolean"}
    ),
    "archived_transactions": Layout(
        {**event_types("transactions"), "processed_at": "timestamp"}, (PERIOD,)
    ),
    # The different keys and the sums of a day in a batch; ``key`` is NULL for sums.
    "daily_keys": Layout(
        {
            "day": "date",
            "key": "string",
            "quantity": "bigint",
            "revenue": "decimal(31,2)",
            "processed_at": "timestamp",
        },
        ("kind", PERIOD),
    ),
    "stream_progress": Layout(
        {
            "stream": "string",
            "run_id": "string",
            "batch": "bigint",
            "input_rows": "bigint",
            "accepted": "bigint",
            "rejected": "bigint",
            "error_class": "string",
            "message": "string",
            "at": "timestamp",
        },
        ("event", PERIOD),
    ),
    "archive_runs": Layout({"cutoff": "timestamp", "through_batch": "bigint"}),
    "daily_reports": Layout(
        {
            "as_of": "timestamp",
            "date": "string",
            "orders": "bigint",
            "total_quantity": "bigint",
            "total_revenue": "double",
            "users": "bigint",
        }
    ),
}
