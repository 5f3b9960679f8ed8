"""Time the headline queries and stream drains; prints one JSON line.

Batch queries: one warm-up, then the median of three runs into the noop sink.
Streams: one warm-up, then the time to drain the landed batches (landing itself is not
timed), and records per second. Jobs over stored tables (gathering the batches of the
drained streams, compaction, the archive move) are timed without filling the tables.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import time

import pyspark
from pyspark.sql import DataFrame, SparkSession

from retailflow import fixtures, queries
from retailflow.functions.parsing import accepted, parse_events
from retailflow.plans.archive import archive_transactions
from retailflow.schemas import EVENTS
from retailflow.session import configure
from retailflow.sources.events import read_files
from retailflow.streaming import jobs
from retailflow.tables import CURRENT, RUNNING, Tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MEMORY = os.environ.get("BENCH_MEMORY", "16g")
ROUNDS = 3

BATCH = [
    "parse_transactions",
    "parse_clickstream",
    "parse_inventory",
    "rejects",
    "category_quantity",
    "city_quantity",
    "payment_quantity",
    "shipping_quantity",
    "quantity_totals",
    "users_distinct",
    "products_distinct",
    "users_current",
    "products_current",
    "payment_methods",
    "shipping_methods",
    "city_sales_geo",
    "daily_summary",
    "orders_today",
    "users_active_today",
    "activity_message",
    "large_orders",
    "large_order_alert",
]


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.monotonic()
    action()
    return time.monotonic() - start


def drain(spark: SparkSession, kind: str, start) -> tuple[dict, Tables]:
    """Drain a topic's batches one by one with ``start(tables, source)``."""
    tables = queries._tables(spark)
    taken, records, batches, state = 0.0, 0, 0, 0
    for pattern in fixtures.land_batches(spark, SF_DIR, kind):
        begin = time.monotonic()
        query = start(tables, lambda s: read_files(s, pattern))
        jobs.wait([query])
        taken += time.monotonic() - begin
        for progress in query.recentProgress:
            records += progress.numInputRows
            batches += progress.numInputRows > 0
            state = max([state, *(s.numRowsTotal for s in progress.stateOperators)])
    return {
        "seconds": round(taken, 3),
        "records": records,
        "records_per_sec": round(records / taken),
        "batches": batches,
        "peak_state_rows": state,
    }, tables


def median_of(action) -> float:
    return round(statistics.median([seconds(action) for _ in range(ROUNDS + 1)][1:]), 3)


def jobs_over_tables(spark: SparkSession, drained: dict[str, Tables]) -> dict[str, float]:
    """Gathering, compaction and the archive, each once over filled tables."""
    logs = {kind: drained[kind] for kind in EVENTS}
    times = {
        f"gather_{kind}": seconds(lambda: tables.gather(f"{kind}_log")) for kind, tables in logs.items()
    }
    orders = drained["transactions"]
    times["gather_quantity_totals"] = seconds(lambda: orders.gather("quantity_totals"))
    times["compact_current"] = seconds(
        lambda: [orders.compact(name) for name in CURRENT if name != RUNNING]
    )
    times["rejects_log"] = seconds(lambda: run(queries.run("rejects_log")(spark, SF_DIR)))
    times["compact_running"] = seconds(lambda: drained[RUNNING].compact(RUNNING))
    times["archive"] = seconds(lambda: archive_transactions(orders, queries.AS_OF))
    return {name: round(value, 3) for name, value in times.items()}


def parsing(spark: SparkSession) -> dict[str, float]:
    """Reading and parsing records that have landed, without making them."""
    times = {}
    for kind in EVENTS:
        folder = fixtures.land(fixtures.records(spark, SF_DIR, kind), kind)
        times[f"parse_landed_{kind}"] = median_of(
            lambda: run(accepted(parse_events(read_files(spark, folder, stream=False), kind)))
        )
    return times


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    times = {}
    for name in BATCH:
        query = queries.run(name)
        times[name] = median_of(lambda: run(query(spark, SF_DIR)))
    times.update(parsing(spark))
    starts = {
        kind: (kind, lambda tables, source, kind=kind: jobs.start_events(tables, kind, source))
        for kind in ("transactions", "clickstream", "inventory")
    }
    starts[RUNNING] = (
        "transactions",
        lambda tables, source: jobs.start_running_totals(tables, source),
    )
    streams, drained = {}, {}
    for name, (kind, start) in starts.items():
        drain(spark, kind, start)
        streams[name], drained[name] = drain(spark, kind, start)
    times.update({f"stream_{name}": figures["seconds"] for name, figures in streams.items()})
    times.update(jobs_over_tables(spark, drained))
    commit = subprocess.run(
        ["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=False
    ).stdout.strip()
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "streams": streams,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
                "driver_memory": MEMORY,
                "shuffle_partitions": int(CPUS),
                "pyspark": pyspark.__version__,
                "commit": commit,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
