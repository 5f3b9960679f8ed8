"""The SQL each query must agree with, written for DuckDB over the test tables."""

from __future__ import annotations

from retailflow import fixtures
from retailflow.operators.totals import DIMENSIONS, KEY_COLUMNS
from retailflow.plans.reports import LARGE_ORDER, LINES_PER_MESSAGE, NOTHING_FOUND
from retailflow.schemas import STORED, columns
from retailflow.tables import GATHERED, TRANSACTION_COLUMNS

DAY = "TIMESTAMP '2001-07-01 00:00:00'"
CUTOFF = "TIMESTAMP '2001-06-01 00:00:00'"
LARGE = 45

TX = f"""tx AS (
SELECT {', '.join(f'{sql} AS {name}' for name, (sql, _) in fixtures.TRANSACTION.items())}
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey)"""

CLICKS = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in fixtures.CLICK.items())
CLICKS += " FROM events"

INVENTORY = "SELECT " + ", ".join(
    f"{fixtures.INVENTORY[name]} AS {name}" for name in columns("inventory")
)
INVENTORY += " FROM lineitem"

QUANTITY = "CAST(sum(quantity) AS BIGINT)"


def _at(select: str, name: str = "processed_at") -> str:
    """The rows with the time at which the registered queries store them."""
    return f"SELECT *, {DAY} AS {name} FROM ({select})"


def _tx(select: str, *more: str) -> str:
    return f"WITH {', '.join([TX, *more])} {select}"


def _list(names) -> str:
    return ", ".join(names)


def _by(dimension: str, quantity: str = "quantity") -> str:
    keys = _list(DIMENSIONS[dimension])
    return f"SELECT {keys}, {QUANTITY} AS {quantity} FROM tx GROUP BY {keys}"


def _batches(dimension: str) -> str:
    keys = _list(DIMENSIONS[dimension])
    return (
        f"SELECT CAST(line_no - 1 AS BIGINT) AS batch_id, {keys}, {QUANTITY} AS quantity "
        f"FROM tx GROUP BY line_no, {keys}"
    )


def _running(dimension: str) -> str:
    keys = _list(DIMENSIONS[dimension])
    return _tx(
        f"SELECT batch_id, {keys}, CAST(sum(quantity) OVER "
        f"(PARTITION BY {keys} ORDER BY batch_id) AS BIGINT) AS quantity "
        f"FROM ({_batches(dimension)})"
    )


def _all_totals() -> str:
    parts = []
    for name, keys in DIMENSIONS.items():
        shown = _list(c if c in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in KEY_COLUMNS)
        parts.append(
            f"SELECT '{name}' AS dimension, {shown}, {QUANTITY} AS quantity "
            f"FROM tx GROUP BY {_list(keys)}"
        )
    return _tx(" UNION ALL ".join(parts))


def _latest(key: str, values: list[str], order: list[str], extra: str = "") -> str:
    descending = _list(f"{name} DESC" for name in [*order, *values])
    return _tx(
        f"SELECT {key}, {_list(values)}{extra} FROM tx "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {descending}) = 1"
    )


def _alert(threshold: int, lines: int) -> str:
    big = f"""big AS (
SELECT concat('Order ID: ', order_id, ', User ID: ', user_id, ', Quantity: ', quantity,
  ', Time: ', strftime(timestamp, '%Y-%m-%d %H:%M:%S')) AS line,
  row_number() OVER (ORDER BY timestamp, order_id, user_id, quantity) - 1 AS n
FROM tx WHERE timestamp >= {DAY} AND quantity > {threshold})"""
    return _tx(
        f"""SELECT CAST(n // {lines} AS BIGINT) AS part,
  string_agg(line, '<br>' ORDER BY n) AS body, true AS found
FROM big GROUP BY n // {lines}
UNION ALL
SELECT CAST(0 AS BIGINT), '{NOTHING_FOUND}', false WHERE NOT EXISTS (SELECT 1 FROM big)""",
        big,
    )


def _rejects() -> str:
    reasons = " ".join(
        f"WHEN {quantity} THEN '{reason}'"
        for quantity, (_, reason) in fixtures.DEFECTS.items()
        if reason
    )
    return _tx(
        f"SELECT {fixtures.dirty_value()} AS value, CASE quantity {reasons} END AS reject_reason "
        f"FROM tx WHERE CASE quantity {reasons} END IS NOT NULL"
    )


def _bad() -> str:
    return _list(str(quantity) for quantity, (_, reason) in fixtures.DEFECTS.items() if reason)


def _accepted() -> str:
    bad = _bad()
    shown = {name: name for name in columns("transactions")}
    shown["price"] = (
        "CAST(CASE WHEN quantity = 14 THEN 123.46 ELSE price END AS DECIMAL(10,2)) AS price"
    )
    shown["timestamp"] = (
        "CASE WHEN quantity = 13 THEN timestamp - INTERVAL 7 HOUR ELSE timestamp END AS timestamp"
    )
    return _tx(f"SELECT {_list(shown.values())} FROM tx WHERE quantity NOT IN ({bad})")


def _catalog_tables() -> str:
    """Every column of the catalog's tables, and the rows of a drained topic's."""
    columns_of = []
    for table, layout in STORED.items():
        layout = layout.by("event_year")
        forms = {table: (layout.read_schema, ("batch_id", *layout.partitions))}
        if table in GATHERED:
            parts = (*layout.partitions, "through")
            forms[f"{table}_gathered"] = (layout.gathered_schema, parts)
        columns_of += [
            f"('{name}', '{f.name}', '{f.dataType.simpleString()}', {f.name in parts})"
            for name, (schema, parts) in forms.items()
            for f in schema
        ]

    def distinct(names: str) -> str:
        return f"(SELECT count(*) FROM (SELECT DISTINCT line_no, {names} FROM tx))"

    totals = " + ".join(distinct(_list(keys)) for keys in DIMENSIONS.values())
    counts = dict.fromkeys(STORED, "0") | {
        "transactions_log": "(SELECT count(*) FROM tx)",
        "quantity_totals": totals,
        "user_changes": distinct("user_id"),
        "product_changes": distinct("product_id"),
    }
    rows = " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", CAST({count} AS BIGINT) AS "rows" """
        for table, count in counts.items()
    )
    return _tx(
        f"""SELECT c.*, n."rows" FROM (VALUES {", ".join(columns_of)})
AS c("table", "column", type, "partition") LEFT JOIN ({rows}) AS n USING ("table")"""
    )


def _city_rows(key: str, table: str) -> str:
    number = {"s": "s_suppkey", "c": "c_custkey"}[key]
    return f"""SELECT {fixtures.CITY[key]} AS city, r_name AS state, {number} AS line,
  CAST({number} % 80 + 0.5 AS DECIMAL(10,8)) AS latitude,
  CAST(-({number} % 180) - 0.25 AS DECIMAL(11,8)) AS longitude
FROM {table} JOIN nation ON {key}_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""


SUPPLIER_CITIES = f"""supplier_cities AS (
{_city_rows('s', 'supplier')} WHERE s_suppkey % 10 NOT IN (7, 8)
QUALIFY row_number() OVER (PARTITION BY city, state ORDER BY line) = 1)"""

CUSTOMER_CITIES = f"""customer_cities AS (
{_city_rows('c', 'customer')} WHERE c_custkey % 10 NOT IN (7, 8)
QUALIFY row_number() OVER (PARTITION BY city, state ORDER BY line) = 1)"""

NEW_CITIES = """SELECT city, state, latitude, longitude FROM customer_cities
WHERE (city, state) NOT IN (SELECT (city, state) FROM supplier_cities)"""


def _rejected_cities(key: str, table: str, load: int) -> str:
    number = {"s": "s_suppkey", "c": "c_custkey"}[key]
    return f"""SELECT {fixtures.CITY[key]} AS city, r_name AS state,
  {fixtures.latitude(number)} AS latitude,
  concat('-', CAST({number} % 180 AS STRING), '.25') AS longitude,
  CASE {number} % 10 WHEN 7 THEN 'missing:latitude' ELSE 'invalid:latitude' END AS reject_reason,
  CAST({load} AS BIGINT) AS batch_id
FROM {table} JOIN nation ON {key}_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE {number} % 10 IN (7, 8)"""


# Records of the topics by what becomes of them.
TOPIC_COUNTS = f"""SELECT 'transactions' AS kind, count(*) FILTER (good) AS accepted,
  count(*) FILTER (NOT good) AS rejected
FROM (SELECT quantity NOT IN ({_bad()}) AS good FROM tx)
UNION ALL SELECT 'clickstream', count(*), 0 FROM events
UNION ALL SELECT 'inventory', count(*), 0 FROM lineitem"""

SUMMARY = f"""count(DISTINCT order_id) AS orders, {QUANTITY} AS total_quantity,
  CAST(sum(price * quantity) AS DECIMAL(31,2)) AS total_revenue,
  count(DISTINCT user_id) AS users
FROM tx WHERE timestamp >= {DAY}"""

ACTIVE = f"""SELECT count(*) FROM
  (SELECT user_id, max(timestamp) AS last_updated FROM tx GROUP BY user_id)
WHERE last_updated >= {DAY}"""

ORDERS = f"SELECT count(*) FROM tx WHERE timestamp >= {DAY}"

SQL: dict[str, str] = {
    "parse_transactions": _tx(f"SELECT {_list(columns('transactions'))} FROM tx"),
    "parse_clickstream": CLICKS,
    "parse_inventory": INVENTORY,
    "rejects": _rejects(),
    "rejects_log": _rejects(),
    "accepted_records": _accepted(),
    **{f"{name}_quantity": _tx(_by(name)) for name in DIMENSIONS},
    "quantity_totals": _all_totals(),
    "users_distinct": _tx("SELECT DISTINCT user_id, user_name, user_email FROM tx"),
    "products_distinct": _tx("SELECT DISTINCT product_id, category, price FROM tx"),
    "users_current": _latest(
        "user_id",
        ["user_name", "user_email"],
        ["timestamp", "order_id"],
        ", timestamp AS last_updated",
    ),
    "products_current": _latest(
        "product_id",
        ["category", "price"],
        ["timestamp", "order_id"],
        ", timestamp AS last_updated",
    ),
    "payment_methods": _tx("SELECT DISTINCT payment_method FROM tx"),
    "shipping_methods": _tx("SELECT DISTINCT shipping_method FROM tx"),
    "coordinates_load": f"""WITH {SUPPLIER_CITIES}, {CUSTOMER_CITIES}
SELECT city, state, latitude, longitude FROM supplier_cities
UNION ALL
{NEW_CITIES}""",
    "coordinates_loaded": f"""WITH {SUPPLIER_CITIES}, {CUSTOMER_CITIES}
SELECT CAST(0 AS BIGINT) AS load, count(*) AS inserted FROM supplier_cities
UNION ALL SELECT 1, count(*) FROM ({NEW_CITIES})""",
    "coordinates_rejected": _rejected_cities("s", "supplier", 0)
    + " UNION ALL "
    + _rejected_cities("c", "customer", 1),
    "city_sales_geo": f"""WITH {TX}, {SUPPLIER_CITIES}, sold AS ({_by('city')})
SELECT sold.city, sold.state, quantity, latitude, longitude
FROM sold LEFT JOIN supplier_cities
ON sold.city = supplier_cities.city AND sold.state = supplier_cities.state""",
    "daily_summary": _tx(f"SELECT CAST({DAY} AS DATE) AS date, {SUMMARY}"),
    "daily_summary_export": _tx(
        f"""SELECT '2001-07-01' AS date, orders, total_quantity,
CAST(total_revenue AS DOUBLE) AS total_revenue, users FROM (SELECT {SUMMARY})"""
    ),
    "orders_today": _tx(f"SELECT ({ORDERS}) AS orders"),
    "users_active_today": _tx(f"SELECT ({ACTIVE}) AS users"),
    "activity_message": _tx(
        f"""SELECT 'Hourly Activity Update' AS subject,
concat('New total orders today: ', ({ORDERS}), ' <br> New user registrations today: ',
({ACTIVE})) AS body"""
    ),
    "large_orders": _tx(
        f"""SELECT order_id, user_id, quantity, timestamp FROM tx
WHERE timestamp >= {DAY} AND quantity > {LARGE}"""
    ),
    "large_order_alert": _alert(LARGE, LINES_PER_MESSAGE),
    "large_order_alert_parts": _alert(LARGE, 25),
    "large_order_alert_none": _alert(LARGE_ORDER, LINES_PER_MESSAGE),
    "archive_moved": _tx(
        f"SELECT {_list(columns('transactions'))} FROM tx WHERE timestamp < {CUTOFF}"
    ),
    **dict.fromkeys(
        ("archive_live", "archive_live_compacted"),
        _tx(f"SELECT {_list(TRANSACTION_COLUMNS)} FROM tx WHERE timestamp >= {CUTOFF}"),
    ),
    "category_batch_log": _tx(_at(_batches("category"))),
    "category_batch_log_compacted": _tx(_at(_batches("category"))),
    "payment_batch_log": _tx(_at(_batches("payment"))),
    "shipping_batch_log": _tx(_at(_batches("shipping"))),
    "category_running_log": _running("category"),
    "city_running_log": _running("city"),
    "payment_running": _tx(_by("payment")),
    "shipping_running": _tx(_by("shipping")),
    "city_sales_stream": _tx(_by("city", "total_quantity")),
    "users_stream": _latest(
        "user_id",
        ["user_name", "user_email"],
        ["line_no", "timestamp", "order_id"],
        f", {DAY} AS last_updated",
    ),
    "products_stream": _latest(
        "product_id",
        ["category", "price"],
        ["line_no", "timestamp", "order_id"],
        f", {DAY} AS last_updated",
    ),
    "transaction_log_old_files": _tx(f"SELECT {_list(TRANSACTION_COLUMNS)} FROM tx"),
    **dict.fromkeys(
        ("transaction_log", "transaction_log_compacted"),
        _tx(f"SELECT {_list(TRANSACTION_COLUMNS)}, {DAY} AS processed_at FROM tx"),
    ),
    **dict.fromkeys(("click_log", "click_log_compacted"), _at(CLICKS)),
    **dict.fromkeys(("inventory_log", "inventory_log_compacted"), _at(INVENTORY)),
    "daily_summary_stored": _tx(f"SELECT CAST({DAY} AS DATE) AS date, {SUMMARY}"),
    # The clock of the stored tables stands at the day of the reports, so every user is active.
    "activity_update_stored": _tx(
        f"""SELECT 'Hourly Activity Update' AS subject,
concat('New total orders today: ', ({ORDERS}), ' <br> New user registrations today: ',
(SELECT count(DISTINCT user_id) FROM tx)) AS body"""
    ),
    "large_order_check_stored": _alert(LARGE, LINES_PER_MESSAGE),
    "payment_methods_stored": _tx(_at("SELECT DISTINCT payment_method FROM tx", "last_updated")),
    "shipping_methods_stored": _tx(_at("SELECT DISTINCT shipping_method FROM tx", "last_updated")),
    "catalog_tables": _catalog_tables(),
    "transaction_log_sql": _tx(
        f"SELECT {_list(TRANSACTION_COLUMNS)} FROM tx WHERE timestamp >= {CUTOFF}"
    ),
    "transaction_log_archived_source": _tx(f"SELECT {_list(TRANSACTION_COLUMNS)} FROM tx"),
    "stream_failures": _tx(
        """SELECT 'transactions' AS stream, 'stopped' AS ended, CAST(NULL AS VARCHAR) AS error_class,
(SELECT count(*) FROM tx) AS accepted
UNION ALL SELECT 'clickstream', 'stopped', NULL, (SELECT count(*) FROM events)
UNION ALL SELECT 'inventory', 'failed', 'FOREACH_BATCH_USER_FUNCTION_ERROR', 0"""
    ),
    "running_state": _tx(
        f"""SELECT 'payment' AS dimension, payment_method AS method, {QUANTITY} AS quantity
FROM tx GROUP BY payment_method
UNION ALL SELECT 'shipping', shipping_method, {QUANTITY} FROM tx GROUP BY shipping_method"""
    ),
    "daily_summary_merged": _tx(f"SELECT CAST({DAY} AS DATE) AS date, {SUMMARY}"),
    "users_bucketed": _latest(
        "user_id",
        ["user_name", "user_email"],
        ["line_no", "timestamp", "order_id"],
        f", {DAY} AS last_updated",
    ),
    "products_bucketed": _latest(
        "product_id",
        ["category", "price"],
        ["line_no", "timestamp", "order_id"],
        f", {DAY} AS last_updated",
    ),
    "all_topics_counts": _tx(
        "SELECT counted, kind, accepted, rejected "
        f"FROM ({TOPIC_COUNTS}), (VALUES ('metrics'), ('log')) AS c(counted)"
    ),
}
