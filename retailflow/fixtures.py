"""The test tables seen as events: typed rows, raw JSON records, and landing files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow import files
from retailflow.schemas import columns
from retailflow.session import scratch_folder, setting

# Each transaction column as an expression over the joined tables, and the last
# table of the chain lineitem > orders > customer > nation > region it needs.
# The expressions are valid in Spark and in DuckDB.
TRANSACTION = {
    "order_id": ("CAST(l_orderkey AS STRING)", "lineitem"),
    "user_id": ("CAST(o_custkey AS STRING)", "orders"),
    "user_name": ("c_name", "customer"),
    "user_email": ("concat(lower(replace(c_name,'#','.')),'@example.com')", "customer"),
    "street": ("concat(CAST(c_custkey AS STRING),' ',c_mktsegment,' St')", "customer"),
    "city": ("n_name", "nation"),
    "state": ("r_name", "region"),
    "postal_code": ("lpad(CAST(c_custkey % 100000 AS STRING),5,'0')", "customer"),
    "country": ("'United States'", "lineitem"),
    "product_id": ("CAST(l_partkey AS STRING)", "lineitem"),
    "category": ("p_type", "part"),
    "price": ("CAST(l_extendedprice AS DECIMAL(10,2))", "lineitem"),
    "quantity": ("CAST(l_quantity AS INT)", "lineitem"),
    "shipping_method": ("o_orderpriority", "orders"),
    "payment_method": ("c_mktsegment", "customer"),
    "timestamp": ("CAST(l_shipdate AS TIMESTAMP)", "lineitem"),
    "line_no": ("l_linenumber", "lineitem"),
}

CHAIN = (
    ("orders", "l_orderkey = o_orderkey"),
    ("customer", "o_custkey = c_custkey"),
    ("nation", "c_nationkey = n_nationkey"),
    ("region", "n_regionkey = r_regionkey"),
)

# A table of so many bytes for each core is read in parts by all of them.
SPLIT = 32 << 20

# Landed files cannot be split, as they are compressed; each has so many records at most.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 500_000}

CLICK = {
    "event_id": "CAST(event_id AS STRING)",
    "user_id": "CAST(user_id AS STRING)",
    "page_url": "concat('/', event_type)",
    "action": "event_type",
    "timestamp": "CAST(ts AS TIMESTAMP)",
}

INVENTORY = {
    "event_id": "concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING))",
    "product_id": "CAST(l_partkey AS STRING)",
    "change_type": "CASE WHEN l_returnflag='R' THEN 'restock' ELSE 'sold' END",
    "quantity_change": "CAST(l_quantity AS INT)",
    "timestamp": "CAST(l_shipdate AS TIMESTAMP)",
    "line_no": "l_linenumber",
}


# City of a supplier or customer in the coordinate files; valid in Spark and in DuckDB.
CITY = {"s": "CASE WHEN s_acctbal < 0 THEN n_name ELSE concat('no ', n_name) END", "c": "n_name"}


def latitude(number: str) -> str:
    """SQL for the text in a coordinate file's latitude, by the row's key."""
    return (
        f"CASE {number} % 10 WHEN 7 THEN CAST(NULL AS STRING) WHEN 8 THEN 'north' "
        f"ELSE concat(CAST({number} % 80 AS STRING), '.5') END"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table for costly per-row work, such as JSON, on every core.

    A test table is one file, which may be a single row group that one task scans. A large
    one has many, so its scan is spread as it is and moves no rows.
    """
    rows, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    if files.size(spark, f"{sf_dir}/{name}.parquet") >= cores * SPLIT:
        return rows
    return rows.repartition(cores)


def transactions(
    spark: SparkSession, sf_dir: str, *names: str, costly: bool = False
) -> DataFrame:
    """The asked-for columns (default: all event columns) of the joined tables.

    Only the tables those columns need are joined: every line item has its order,
    part and customer, so a join that adds no column changes nothing.
    """
    names = names or tuple(columns("transactions"))
    needed = {TRANSACTION[name][1] for name in names}
    rows = (spread if costly else table)(spark, sf_dir, "lineitem")
    if "part" in needed:
        rows = rows.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    chain = [name for name, _ in CHAIN]
    reach = max((chain.index(name) + 1 for name in needed if name in chain), default=0)
    if reach:
        # Orders get their customer's columns first: they are fewer than the line items.
        orders = table(spark, sf_dir, CHAIN[0][0])
        for name, on in CHAIN[1:reach]:
            orders = orders.join(table(spark, sf_dir, name), F.expr(on))
        rows = rows.join(orders, F.expr(CHAIN[0][1]))
    return rows.selectExpr(*[f"{TRANSACTION[name][0]} AS {name}" for name in names])


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "events").selectExpr(
        *[f"{expression} AS {name}" for name, expression in CLICK.items()]
    )


def inventory(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    names = names or tuple(columns("inventory"))
    return spread(spark, sf_dir, "lineitem").selectExpr(
        *[f"{INVENTORY[name]} AS {name}" for name in names]
    )


def events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """All event columns of a kind, and ``batch``: which of the streamed batches it is in."""
    if kind == "clickstream":
        return clicks(spark, sf_dir).withColumn("batch", F.lit(1))
    names = (*columns(kind), "line_no")
    if kind == "transactions":
        rows = transactions(spark, sf_dir, *names, costly=True)
    else:
        rows = inventory(spark, sf_dir, *names)
    return rows.withColumnRenamed("line_no", "batch")


def to_records(rows: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Rows as the JSON text a producer sends; times as ISO-8601 with an offset."""
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp")
    fields = [time if name == "timestamp" else F.col(name) for name in columns(kind)]
    return rows.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return to_records(events(spark, sf_dir, kind), kind)


DAY = 24 * 60 * 60 * 1000
NOW = 1_700_000_000_000  # when the newest of the dated files was written


def land(rows: DataFrame, name: str) -> str:
    """Write records where a stream can read them, all at once."""
    folder = scratch_folder(rows.sparkSession, f"landing-{name}")
    rows.select("value").write.options(**LANDED).text(folder)
    return folder


def land_batches(
    spark: SparkSession, sf_dir: str, kind: str, days_back: int = 0
) -> Iterator[str]:
    """Write the records once, then make one batch after another appear in a folder.

    Yields the pattern a stream reads, each time after the next batch has landed. Each
    batch's files are dated ``days_back`` days before those of the batch before it.
    """
    folder = scratch_folder(spark, f"landing-{kind}")
    rows = to_records(events(spark, sf_dir, kind), kind, "batch")
    # A file open for each of the few batches, so the rows are not sorted by batch.
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "16"):
        rows.write.options(**LANDED).partitionBy("batch").text(f"{folder}/staged")
    files.create_folder(spark, f"{folder}/landed")
    staged = [name for name in files.names(spark, f"{folder}/staged") if "=" in name]
    for number, name in enumerate(sorted(staged, key=lambda name: int(name.partition("=")[2]))):
        landed = f"{folder}/landed/{name.replace('=', '-')}"
        for path in files.files_below(spark, f"{folder}/staged/{name}") if days_back else ():
            files.set_modified(spark, path, NOW - number * days_back * DAY)
        files.move(spark, f"{folder}/staged/{name}", landed)
        yield f"{folder}/landed/*"


def _json(*overrides: tuple[str, str]) -> str:
    """SQL for a transaction's JSON text; an override replaces a field's text, '' drops it."""
    texts = {
        name: f"""'"{name}":"',{name},'"'""" for name in columns("transactions")
    }
    texts["price"] = """'"price":',CAST(price AS STRING)"""
    texts["quantity"] = """'"quantity":',CAST(quantity AS STRING)"""
    texts["timestamp"] = """'"timestamp":"',CAST(timestamp AS STRING),'+00:00"'"""
    texts.update(overrides)
    body = ",',',".join(text for text in texts.values() if text)
    return f"concat('{{',{body},'}}')"


# What is done to the transactions of a given quantity, and the reason expected; the
# SQL is valid in Spark and in DuckDB. Other quantities stay as they are.
DEFECTS: dict[int, tuple[str, str | None]] = {
    1: ("concat('{\"order_id\":\"',order_id)", "unreadable"),
    2: ("concat('[',order_id,']')", "unreadable"),
    3: (_json(("quantity", "'\"quantity\":\"3\"'")), "invalid:quantity"),
    4: (_json(("quantity", "'\"quantity\":4.5'")), "invalid:quantity"),
    5: (_json(("user_id", "")), "missing:user_id"),
    6: (_json(("price", "'\"price\":99999999999.1'")), "invalid:price"),
    7: (
        _json(("postal_code", "'\"postal_code\":\"',repeat(postal_code,5),'\"'")),
        "too_long:postal_code",
    ),
    8: (_json(("timestamp", "'\"timestamp\":\"yesterday\"'")), "invalid:timestamp"),
    9: (_json(("timestamp", "")), "missing:timestamp"),
    10: ("''", "unreadable"),
    11: (_json(("country", "'\"country\":\"',country,'\",\"gift\":true'")), None),
    12: (
        _json(
            ("user_email", "'\"user_email\":null'"),
            ("payment_method", "'\"payment_method\":\"',repeat(payment_method,21),'\"'"),
        ),
        "missing:user_email,too_long:payment_method",
    ),
    13: (
        _json(("timestamp", "'\"timestamp\":\"',CAST(timestamp AS STRING),'+07:00\"'")),
        None,
    ),
    14: (_json(("price", "'\"price\":123.455'")), None),
}


def dirty_value() -> str:
    """SQL for the record of each transaction, spoiled by its quantity."""
    cases = " ".join(f"WHEN {quantity} THEN {sql}" for quantity, (sql, _) in DEFECTS.items())
    return f"CASE quantity {cases} ELSE {_json()} END"


def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir, costly=True).selectExpr(f"{dirty_value()} AS value")
