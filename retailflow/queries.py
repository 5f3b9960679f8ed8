"""Every operator as a query over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow import fixtures
from retailflow.catalog import Catalog
from retailflow.functions.parsing import accepted, parse_events, rejected
from retailflow.operators import latest, totals
from retailflow.plans import archive, reports, scheduled
from retailflow.schemas import EVENTS, columns
from retailflow.session import configure, scratch_folder
from retailflow.sources.events import read_files
from retailflow.snapshots import Snapshots
from retailflow.streaming import jobs
from retailflow.streaming.progress import Progress
from retailflow.tables import GATHERED, RUNNING, TRANSACTION_COLUMNS, Tables

AS_OF = datetime(2001, 7, 1)
LARGE = 45

Query = Callable[[SparkSession, str], DataFrame]


# -- batch

def _parsed(kind: str) -> Query:
    return lambda spark, sf: accepted(parse_events(fixtures.records(spark, sf, kind), kind))


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    return parse_events(fixtures.dirty_records(spark, sf), "transactions")


def _quantity(dimension: str) -> Query:
    keys = totals.DIMENSIONS[dimension]
    return lambda spark, sf: totals.quantity_by(
        fixtures.transactions(spark, sf, *keys, "quantity"), dimension
    )


def _quantity_totals(spark: SparkSession, sf: str) -> DataFrame:
    return totals.quantity_totals(
        fixtures.transactions(spark, sf, *totals.KEY_COLUMNS, "quantity")
    )


def _users(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf, *latest.USER, "order_id", "timestamp")
    return latest.latest_users(rows, F.col("timestamp"))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf, *latest.PRODUCT, "order_id", "timestamp")
    return latest.latest_products(rows, F.col("timestamp"))


def _methods(column: str) -> Query:
    return lambda spark, sf: fixtures.transactions(spark, sf, column).distinct()


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.transactions(
        spark, sf, "order_id", "user_id", "quantity", "price", "timestamp"
    )
    return reports.daily_summary(rows, AS_OF)


def _summary_export(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.transactions(
        spark, sf, "order_id", "user_id", "quantity", "price", "timestamp"
    )
    return scheduled.export_daily_summary(_tables(spark), rows, AS_OF)


def _times(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions(spark, sf, "timestamp")


def _user_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The users' change log, taking a change to be stored when it happens."""
    rows = fixtures.transactions(spark, sf, "user_id", "timestamp")
    return rows.withColumnRenamed("timestamp", "last_updated")


def _large(spark: SparkSession, sf: str, threshold: int) -> DataFrame:
    rows = fixtures.transactions(spark, sf, "order_id", "user_id", "quantity", "timestamp")
    return reports.large_orders(rows, AS_OF, threshold)


def _alert(threshold: int, lines: int) -> Query:
    return lambda spark, sf: reports.large_order_alert(
        _large(spark, sf, threshold), scratch_folder(spark, "alert"), lines
    )


# -- stored tables

def _tables(spark: SparkSession) -> Tables:
    # A few thousand rows spread over seven years: a folder per day would hold ten rows.
    tables = Tables(spark, scratch_folder(spark, "tables"), period="year")
    tables.create()
    return tables


def _clock() -> datetime:
    return AS_OF


def _coordinates(spark: SparkSession, sf: str, name: str) -> str:
    """A CSV with a city row per supplier or customer, in key order.

    Suppliers without debt get a city nobody lives in, so some cities have no coordinates;
    of ten rows, one has no latitude and one no number there.
    """
    key = name[0]
    number = {"s": "s_suppkey", "c": "c_custkey"}[key]
    rows = (
        fixtures.table(spark, sf, name)
        .join(fixtures.table(spark, sf, "nation"), F.expr(f"{key}_nationkey = n_nationkey"))
        .join(fixtures.table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .orderBy(number)
        .selectExpr(
            f"{fixtures.CITY[key]} AS city",
            "r_name AS state",
            f"{fixtures.latitude(number)} AS latitude",
            f"concat('-', CAST({number} % 180 AS STRING), '.25') AS longitude",
        )
    )
    path = scratch_folder(spark, f"coordinates-{name}")
    rows.write.option("header", True).csv(path)
    return path


def _loaded(spark: SparkSession, sf: str) -> tuple[Tables, list[int]]:
    tables = _tables(spark)
    files = [_coordinates(spark, sf, name) for name in ("supplier", "customer")]
    return tables, [scheduled.load_coordinates(tables, path) for path in files]


def _coordinates_load(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)[0].read("us_coordinates")


def _coordinates_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The number of cities that each load says it inserted."""
    counts = list(enumerate(_loaded(spark, sf)[1]))
    return spark.createDataFrame(counts, "load long, inserted long")


def _coordinates_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)[0].read("coordinate_rejects")


def _city_sales_geo(spark: SparkSession, sf: str) -> DataFrame:
    tables = _tables(spark)
    scheduled.load_coordinates(tables, _coordinates(spark, sf, "supplier"))
    return reports.city_sales_geo(
        _quantity("city")(spark, sf), tables.read("us_coordinates")
    )


def _rejects_log(spark: SparkSession, sf: str) -> DataFrame:
    tables = _tables(spark)
    jobs.ingest(tables, "transactions", fixtures.dirty_records(spark, sf), _clock)
    return tables.read("rejects").select("value", "reject_reason")


def _archived(spark: SparkSession, sf: str, gathered: bool = False) -> Tables:
    tables = _tables(spark)
    raw = fixtures.records(spark, sf, "transactions")
    jobs.ingest(tables, "transactions", raw, _clock)
    if gathered:
        tables.gather("transactions_log")
    archive.archive_transactions(tables, AS_OF)
    return tables


def _archive_moved(spark: SparkSession, sf: str) -> DataFrame:
    rows = _archived(spark, sf).read("archived_transaction_data")
    return rows.select(*columns("transactions"))


def _archive_live(spark: SparkSession, sf: str, gathered: bool = False) -> DataFrame:
    return _archived(spark, sf, gathered).read("transaction_data").select(*TRANSACTION_COLUMNS)


# -- streams

def _streamed(spark: SparkSession, sf: str, kind: str) -> Tables:
    """What a drained topic leaves behind."""
    return _drained(spark, sf, kind)


def _drained(spark: SparkSession, sf: str, kind: str) -> Tables:
    """Drain the batches of a topic one by one, starting anew on the same checkpoint."""
    tables = _tables(spark)
    for pattern in fixtures.land_batches(spark, sf, kind):
        jobs.wait([jobs.start_events(tables, kind, lambda s: read_files(s, pattern), _clock)])
    return tables


def _from_stream(kind: str, name: str, *names: str) -> Query:
    return lambda spark, sf: _streamed(spark, sf, kind).read(name).select(*names)


def _gathered(kind: str, name: str, *names: str) -> Query:
    """A log whose batches were gathered twice while they came, and has some ungathered."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tables = _tables(spark)
        for number, pattern in enumerate(fixtures.land_batches(spark, sf, kind)):
            jobs.wait([jobs.start_events(tables, kind, lambda s: read_files(s, pattern), _clock)])
            for table in GATHERED if number in (0, 2, 4) else ():
                tables.gather(table)
        return tables.read(name).select(*names)

    return query


def _old_files(spark: SparkSession, sf: str) -> DataFrame:
    """Batches whose files are each more than a week older than those before."""
    tables = _tables(spark)
    for pattern in fixtures.land_batches(spark, sf, "transactions", days_back=8):
        source = lambda s: read_files(s, pattern)
        jobs.wait([jobs.start_events(tables, "transactions", source, _clock)])
    return tables.read("transaction_data").select(*TRANSACTION_COLUMNS)


def _archived_source(spark: SparkSession, sf: str) -> DataFrame:
    """Batches whose files move away once they are read."""
    tables = _tables(spark)
    for pattern in fixtures.land_batches(spark, sf, "transactions"):
        source = lambda s: read_files(s, pattern, archive=tables.read_folder("transactions"))
        jobs.wait([jobs.start_events(tables, "transactions", source, _clock)])
    return tables.read("transaction_data").select(*TRANSACTION_COLUMNS)


def _catalog(tables: Tables) -> Catalog:
    """A database of its own for each run, created a second time as a later job would."""
    catalog = Catalog(tables, f"shop_{uuid.uuid4().hex}")
    catalog.create()
    catalog.create()
    catalog.refresh()
    return catalog


def _catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the catalog's tables, and the rows a drained topic left in them."""
    tables = _drained(spark, sf, "transactions")
    for name in ("transactions_log", "quantity_totals"):
        tables.gather(name)
    catalog = _catalog(tables)
    return catalog.describe().join(catalog.counts(), "table", "left")


def _transaction_log_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The transactions by a name of the catalog, half gathered and partly archived."""
    tables = _tables(spark)
    for number, pattern in enumerate(fixtures.land_batches(spark, sf, "transactions")):
        source = lambda s: read_files(s, pattern)
        jobs.wait([jobs.start_events(tables, "transactions", source, _clock)])
        if number == 3:
            tables.gather("transactions_log")
    archive.archive_transactions(tables, AS_OF)
    name = _catalog(tables).name("transaction_data")
    return spark.sql(f"SELECT {', '.join(TRANSACTION_COLUMNS)} FROM {name}")


def _stream_failures(spark: SparkSession, sf: str) -> DataFrame:
    """One topic of three cannot be read: what is told of each query's end, and its rows."""
    tables = _tables(spark)
    landed = {k: fixtures.land(fixtures.records(spark, sf, k), k) for k in EVENTS}

    def source(kind: str) -> jobs.Source:
        # The files of one topic are not of the format they are announced in.
        fmt = "parquet" if kind == "inventory" else "text"
        return lambda s: read_files(s, landed[kind], fmt)

    progress = Progress(tables, _clock)
    every = {"processingTime": "1 second"}
    sound = {k: source(k) for k in EVENTS if k != "inventory"}
    started = jobs.start_all(tables, sound, clock=_clock, trigger=every, progress=progress)
    for query in started:
        query.processAllAvailable()
    started += jobs.start_all(
        tables, {"inventory": source("inventory")}, clock=_clock, trigger=every, progress=progress
    )
    try:
        jobs.wait(started, progress=progress)
    except StreamingQueryException:
        pass  # it is a row now
    told = tables.read("stream_progress")
    return told.groupBy("stream").agg(
        F.max(F.when(F.col("event").isin("failed", "stopped"), F.col("event"))).alias("ended"),
        F.max("error_class").alias("error_class"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
    )


def _running_state(spark: SparkSession, sf: str) -> DataFrame:
    """The totals by payment and shipping method in the state store."""
    tables = _run_totals(spark, sf)
    frames = [
        jobs.running_state(tables, dimension).toDF("method", "quantity").select(
            F.lit(dimension).alias("dimension"), "method", "quantity"
        )
        for dimension in ("payment", "shipping")
    ]
    return frames[0].unionByName(frames[1])


def _daily_summary_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The summary from the keys of batches, some of them gathered."""
    tables = _tables(spark)
    for number, pattern in enumerate(fixtures.land_batches(spark, sf, "transactions")):
        source = lambda s: read_files(s, pattern)
        jobs.wait([jobs.start_events(tables, "transactions", source, _clock, daily=True)])
        if number in (2, 4):
            tables.gather("daily_keys")
    return reports.daily_summary_merged(tables.read("daily_keys"), AS_OF)


def _bucketed(name: str, *names: str) -> Query:
    """A current table over a bucketed snapshot, renewed twice, and the changes since."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tables = _tables(spark)
        catalog = _catalog(tables)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        snapshots = Snapshots(catalog, buckets)
        for number, pattern in enumerate(fixtures.land_batches(spark, sf, "transactions")):
            source = lambda s: read_files(s, pattern)
            jobs.wait([jobs.start_events(tables, "transactions", source, _clock)])
            if number in (1, 3):
                snapshots.compact(name)
        return snapshots.current(name).select(*names)

    return query


def _all_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The three topics drained side by side: what their metrics and their logs count."""
    tables = _tables(spark)
    landed = {
        kind: fixtures.land(
            fixtures.dirty_records(spark, sf)
            if kind == "transactions"
            else fixtures.records(spark, sf, kind),
            kind,
        )
        for kind in EVENTS
    }

    def source(folder: str) -> jobs.Source:
        return lambda s: read_files(s, folder)

    started = jobs.start_all(tables, {k: source(f) for k, f in landed.items()}, clock=_clock)
    jobs.wait(started)
    counts = []
    for query in started:
        seen = [p.observedMetrics[f"{query.name}_quality"] for p in query.recentProgress]
        accepted_rows = sum(m["accepted"] for m in seen)
        counts.append(("metrics", query.name, accepted_rows, sum(m["rejected"] for m in seen)))
    metrics = spark.createDataFrame(
        counts, "counted string, kind string, accepted long, rejected long"
    )
    logs = [
        tables.read_stored(f"{kind}_log", kind).agg(
            F.count_if(F.col("status") == "accepted").alias("accepted"),
            F.count_if(F.col("status") == "rejected").alias("rejected"),
        ).select(F.lit("log").alias("counted"), F.lit(kind).alias("kind"), "accepted", "rejected")
        for kind in EVENTS
    ]
    return metrics.unionByName(logs[0]).unionByName(logs[1]).unionByName(logs[2])


def _large_order_check(spark: SparkSession, sf: str) -> DataFrame:
    tables = _streamed(spark, sf, "transactions")
    return scheduled.large_order_check(tables, AS_OF, scratch_folder(spark, "alert"), LARGE)


def _run_totals(spark: SparkSession, sf: str) -> Tables:
    tables = _tables(spark)
    for pattern in fixtures.land_batches(spark, sf, "transactions"):
        jobs.wait([jobs.start_running_totals(tables, lambda s: read_files(s, pattern), _clock)])
    return tables


def _running_log(dimension: str) -> Query:
    """Every total the stateful stream emitted, with the batch that changed it."""
    return lambda spark, sf: (
        _run_totals(spark, sf)
        .read_stored(RUNNING, RUNNING)
        .filter(F.col("dimension") == dimension)
        .select("batch_id", *totals.DIMENSIONS[dimension], "quantity")
    )


def _running(dimension: str) -> Query:
    """The newest total of each key, after a compaction."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tables = _run_totals(spark, sf)
        tables.compact(RUNNING)
        return tables.running(dimension).select(*totals.DIMENSIONS[dimension], "quantity")

    return query


QUERIES: dict[str, Query] = {
    # S1-S3, P1-P4, P6, P7
    "parse_transactions": _parsed("transactions"),
    "parse_clickstream": _parsed("clickstream"),
    "parse_inventory": _parsed("inventory"),
    # F5
    "rejects": lambda spark, sf: rejected(_dirty(spark, sf)),
    "accepted_records": lambda spark, sf: accepted(_dirty(spark, sf)),
    "rejects_log": _rejects_log,
    # A1-A4, C1, C2
    "category_quantity": _quantity("category"),
    "city_quantity": _quantity("city"),
    "payment_quantity": _quantity("payment"),
    "shipping_quantity": _quantity("shipping"),
    "quantity_totals": _quantity_totals,
    # P5, D1, D2
    "users_distinct": lambda spark, sf: latest.distinct_users(
        fixtures.transactions(spark, sf, *latest.USER)
    ),
    "products_distinct": lambda spark, sf: latest.distinct_products(
        fixtures.transactions(spark, sf, *latest.PRODUCT)
    ),
    # K1, K2
    "users_current": _users,
    "products_current": _products,
    # C3
    "payment_methods": _methods("payment_method"),
    "shipping_methods": _methods("shipping_method"),
    # S4, S6, P13, K4
    "coordinates_load": _coordinates_load,
    # C9
    "coordinates_loaded": _coordinates_loaded,
    "coordinates_rejected": _coordinates_rejected,
    # C4
    "city_sales_geo": _city_sales_geo,
    # R1, F1, A5-A7, P10, P11
    "daily_summary": _summary,
    # P17, W7
    "daily_summary_export": _summary_export,
    # R2-R4, F2, A8, A9, P16
    "orders_today": lambda spark, sf: reports.orders_today(_times(spark, sf), AS_OF),
    "users_active_today": lambda spark, sf: reports.users_active_today(
        _user_changes(spark, sf), AS_OF
    ),
    "activity_message": lambda spark, sf: reports.activity_message(
        _times(spark, sf), _user_changes(spark, sf), AS_OF
    ),
    # R5, R6, F3, P14, P15
    "large_orders": lambda spark, sf: _large(spark, sf, LARGE),
    "large_order_alert": _alert(LARGE, reports.LINES_PER_MESSAGE),
    "large_order_alert_parts": _alert(LARGE, 25),
    "large_order_alert_none": _alert(reports.LARGE_ORDER, reports.LINES_PER_MESSAGE),
    # R7, F4, P12, W6, C5
    "archive_moved": _archive_moved,
    "archive_live": _archive_live,
    "archive_live_compacted": lambda spark, sf: _archive_live(spark, sf, gathered=True),
    # T1, T3, T4, T6, W1, P8, P9, C1, C2
    "category_batch_log": _from_stream(
        "transactions", "batch_details", "batch_id", "category", "quantity", "processed_at"
    ),
    "payment_batch_log": _from_stream(
        "transactions", "sales_by_payment", "batch_id", "payment_method", "quantity", "processed_at"
    ),
    "shipping_batch_log": _from_stream(
        "transactions", "sales_by_shipping", "batch_id", "shipping_method", "quantity",
        "processed_at",
    ),
    # T2, T5, W1
    "category_running_log": _running_log("category"),
    "city_running_log": _running_log("city"),
    "payment_running": _running("payment"),
    "shipping_running": _running("shipping"),
    # K3, A10, C6
    "city_sales_stream": _from_stream(
        "transactions", "sales_per_city", "city", "state", "total_quantity"
    ),
    # K1, K2 over batches
    "users_stream": _from_stream("transactions", "users", *latest.USER, "last_updated"),
    "products_stream": _from_stream(
        "transactions", "products", *latest.PRODUCT, "last_updated"
    ),
    # W2-W4, S5, P8
    "transaction_log": _from_stream(
        "transactions", "transaction_data", *TRANSACTION_COLUMNS, "processed_at"
    ),
    "click_log": _from_stream(
        "clickstream", "clickstream_logs", *columns("clickstream"), "processed_at"
    ),
    "inventory_log": _from_stream(
        "inventory", "inventory_updates", *columns("inventory"), "processed_at"
    ),
    # S1-S3: files dated back; logs gathered while they grow
    "transaction_log_old_files": _old_files,
    "transaction_log_compacted": _gathered(
        "transactions", "transaction_data", *TRANSACTION_COLUMNS, "processed_at"
    ),
    "click_log_compacted": _gathered(
        "clickstream", "clickstream_logs", *columns("clickstream"), "processed_at"
    ),
    "inventory_log_compacted": _gathered(
        "inventory", "inventory_updates", *columns("inventory"), "processed_at"
    ),
    "category_batch_log_compacted": _gathered(
        "transactions", "batch_details", "batch_id", "category", "quantity", "processed_at"
    ),
    # R1-R6, C3 over stored tables
    "daily_summary_stored": lambda spark, sf: reports.daily_summary(
        _streamed(spark, sf, "transactions").read("transaction_data"), AS_OF
    ),
    "activity_update_stored": lambda spark, sf: scheduled.activity_update(
        _streamed(spark, sf, "transactions"), AS_OF
    ),
    "large_order_check_stored": _large_order_check,
    "payment_methods_stored": _from_stream(
        "transactions", "payment_methods", "payment_method", "last_updated"
    ),
    "shipping_methods_stored": _from_stream(
        "transactions", "shipping_methods", "shipping_method", "last_updated"
    ),
    # S6, W5, S5: the session catalog
    "catalog_tables": _catalog_tables,
    "transaction_log_sql": _transaction_log_sql,
    # S1-S3: read files move away
    "transaction_log_archived_source": _archived_source,
    # C8
    "stream_failures": _stream_failures,
    # T5: the state store read back
    "running_state": _running_state,
    # A5, R1 by union of keys
    "daily_summary_merged": _daily_summary_merged,
    # K1, K2 over bucketed snapshots
    "users_bucketed": _bucketed("users", *latest.USER, "last_updated"),
    "products_bucketed": _bucketed("products", *latest.PRODUCT, "last_updated"),
    # T7, C7, C8
    "all_topics_counts": _all_topics,
}


def run(name: str) -> Query:
    return lambda spark, sf: QUERIES[name](configure(spark), sf)
