"""Streaming jobs over the event topics."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from retailflow import files
from retailflow.functions.parsing import accepted, parse_events
from retailflow.functions.timing import instant, period_start
from retailflow.operators.latest import latest_products, latest_users
from retailflow.operators import totals
from retailflow.operators.totals import daily_keys, quantity_totals
from retailflow.session import stateful_session
from retailflow.streaming.progress import Progress
from retailflow.tables import RUNNING, Tables

Clock = Callable[[], datetime]
Source = Callable[[SparkSession], DataFrame]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def write_log(tables: Tables, kind: str, parsed: DataFrame, batch_id: int, now: datetime) -> None:
    """Write good and rejected records of a batch in one pass over its source.

    A good record's folder is the period of its time; one that has none, and a rejected
    record, are filed under the period they arrived in.
    """
    good = F.col("reject_reason").isNull()
    time = F.coalesce(F.when(good, F.col("timestamp")), instant(now))
    rows = parsed.withColumns(
        {
            "processed_at": instant(now),
            "status": F.when(good, F.lit("accepted")).otherwise(F.lit("rejected")),
            tables.period_column: period_start(time, tables.period),
        }
    )
    tables.write_batch(f"{kind}_log", rows, batch_id)


def _stamped(tables: Tables, rows: DataFrame, now: datetime) -> DataFrame:
    """``rows`` with the time they were processed, and its period."""
    period = period_start(instant(now), tables.period)
    return rows.withColumns({"processed_at": instant(now), tables.period_column: period})


def derive_tables(
    tables: Tables, batch_id: int, now: datetime, daily: bool = False
) -> None:
    """Fill the totals and the current tables from the transactions just logged.

    With ``daily``, the keys and sums of each day as well, for ``daily_summary_merged``.

    They read the few columns they need from the written batch: the source is read
    and parsed once, nothing is cached, and a lost executor costs a re-read. The
    jobs run side by side, so one's last tasks leave no cores idle.
    """
    events = tables.read_batch("transactions_log", batch_id).filter(
        F.col("status") == "accepted"
    )
    updated = instant(now)
    derived = {
        "quantity_totals": _stamped(tables, quantity_totals(events), now),
        "user_changes": latest_users(events, updated),
        "product_changes": latest_products(events, updated),
    }

    if daily:
        derived["daily_keys"] = _stamped(tables, daily_keys(events), now)

    @inheritable_thread_target(tables.spark)
    def write(table: str) -> None:
        tables.write_batch(table, derived[table], batch_id)

    with ThreadPoolExecutor(len(derived)) as pool:
        list(pool.map(write, derived))


def handle_batch(
    tables: Tables,
    kind: str,
    clock: Clock = utc_now,
    owner: str | None = None,
    daily: bool = False,
):
    """The foreachBatch function of one topic; repeating a batch changes nothing.

    A batch is claimed for ``owner`` before anything is written. A stream is one owner over
    its restarts, so it repeats a batch that it had begun; a loader is one by each call.
    """
    owner = owner or f"loader {uuid.uuid4().hex}"

    def handle(parsed: DataFrame, batch_id: int) -> None:
        if batch_id <= tables.committed(kind):
            return
        tables.claim(kind, batch_id, owner)
        try:
            now = clock()
            write_log(tables, kind, parsed, batch_id, now)
            if kind == "transactions":
                derive_tables(tables, batch_id, now, daily)
            tables.commit(kind, batch_id)
        finally:
            tables.release(kind, batch_id)

    return handle


def ingest(tables: Tables, kind: str, raw: DataFrame, clock: Clock = utc_now) -> int:
    """Load a batch of raw records as the next batch of tables no stream writes to.

    Refused once the topic has a stream: that counts its batches itself, and the one
    numbered like this would be taken for a repetition and skipped. Refused as well while
    another loader writes the same batch.
    """
    if files.exists(tables.spark, tables.checkpoint(kind)):
        raise RuntimeError(f"a stream writes the {kind} tables; ingest would hide its next batch")
    batch_id = tables.committed(kind) + 1
    handle_batch(tables, kind, clock)(parse_events(raw, kind), batch_id)
    return batch_id


def _checkpoint(tables: Tables, stream: str) -> str:
    """The stream's own checkpoint folder, unique by the stream's name.

    Batch numbers come from the checkpoint. One that was lost, emptied or put back from
    an old copy would count again from an earlier number, and batches up to the tables'
    last would be skipped as repetitions; it is refused. Spark notes a batch's offsets
    before it runs the batch, so a whole checkpoint reaches as far as the tables.
    """
    folder = tables.checkpoint(stream)
    last = tables.committed(stream)
    if last >= 0:
        offsets = files.names(tables.spark, f"{folder}/offsets")
        reached = max((int(name) for name in offsets if name.isdigit()), default=-1)
        if reached < last:
            raise RuntimeError(
                f"the {stream} tables have batches up to {last} but their checkpoint is gone "
                f"or reaches only {reached}"
            )
    return folder


def start_events(
    tables: Tables,
    kind: str,
    source: Source,
    clock: Clock = utc_now,
    trigger: dict | None = None,
    daily: bool = False,
) -> StreamingQuery:
    """Start the query of one topic; by default it drains what is there and stops.

    Progress metrics carry the accepted and rejected counts of each batch.
    """
    good = F.col("reject_reason").isNull()
    parsed = parse_events(source(tables.spark), kind).observe(
        f"{kind}_quality",
        F.count_if(good).alias("accepted"),
        F.count_if(~good).alias("rejected"),
    )
    return (
        parsed.writeStream.queryName(kind)
        .outputMode("append")
        .option("checkpointLocation", _checkpoint(tables, kind))
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(handle_batch(tables, kind, clock, f"stream {kind}", daily))
        .start()
    )


# State partitions of the running totals unless the caller sizes them to the keys.
STATE_PARTITIONS = 8


def start_running_totals(
    tables: Tables,
    source: Source,
    clock: Clock = utc_now,
    trigger: dict | None = None,
    partitions: int = STATE_PARTITIONS,
    progress: Progress | None = None,
) -> StreamingQuery:
    """Start the stateful query that logs the all-time total of each key a batch touches.

    One query keeps the totals of all dimensions: the topic is read and parsed once.
    The rows are snapshots, not increments: the newest row of a key replaces the
    older ones. ``partitions`` is frozen by the first start; size it to the number
    of keys.
    """
    session = stateful_session(tables.spark, partitions)
    if progress:
        progress.attach(session)
    events = accepted(parse_events(source(session), "transactions"))

    def handle(rows: DataFrame, batch_id: int) -> None:
        if batch_id <= tables.committed(RUNNING):
            # A repetition: its state must be computed again, its rows are there.
            rows.write.format("noop").mode("overwrite").save()
            return
        tables.write_batch(RUNNING, _stamped(tables, rows, clock()), batch_id)
        tables.commit(RUNNING, batch_id)

    return (
        quantity_totals(events)
        .writeStream.queryName(RUNNING)
        .outputMode("update")
        .option("checkpointLocation", _checkpoint(tables, RUNNING))
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(handle)
        .start()
    )


def running_state(tables: Tables, dimension: str) -> DataFrame:
    """The totals as the stateful query's state store holds them, after its last batch.

    Read from the checkpoint, whether or not the query runs: what the next batch will add to.
    """
    keys = totals.DIMENSIONS[dimension]
    state = tables.spark.read.format("statestore").load(tables.checkpoint(RUNNING))
    bits = totals.grouping_bits(dimension)
    # The keys of the state are the grouping columns, then the grouping's number.
    number = state.schema["key"].dataType.names[-1]
    total = state.schema["value"].dataType.names[0]
    return state.filter(F.col(f"key.{number}") == bits).select(
        *[F.col(f"key.{key}").alias(key) for key in keys],
        F.col(f"value.{total}").cast("bigint").alias("quantity"),
    )


def start_all(
    tables: Tables,
    sources: dict[str, Source],
    running: bool = False,
    clock: Clock = utc_now,
    trigger: dict | None = None,
    partitions: int = STATE_PARTITIONS,
    progress: Progress | None = None,
    daily: bool = False,
) -> list[StreamingQuery]:
    """Start the query of every topic in ``sources`` and, if asked for, the running totals."""
    if progress:
        progress.attach(tables.spark)
    started = [
        start_events(tables, kind, source, clock, trigger, daily)
        for kind, source in sources.items()
    ]
    if running:
        orders = sources["transactions"]
        started.append(
            start_running_totals(tables, orders, clock, trigger, partitions, progress)
        )
    return started


# How often what the queries report is stored, in seconds, and how long a look at them is apart
# without a listener.
FLUSH, LOOK = 60, 0.2


def wait(
    queries: Iterable[StreamingQuery],
    seconds: float | None = None,
    progress: Progress | None = None,
) -> None:
    """Wait for all queries, or stop them after ``seconds``; any failure stops all.

    All queries are looked at together: with ``progress``, as soon as it hears that one has
    ended. It is flushed on the way and at the end, so a failure is a row of
    ``stream_progress`` by the time it is raised here.
    """
    queries = list(queries)
    end = None if seconds is None else time.monotonic() + seconds
    flushed = time.monotonic()
    try:
        while any(query.isActive for query in queries):
            if any(query.exception() is not None for query in queries):
                break
            left = FLUSH if end is None else max(0.0, end - time.monotonic())
            if progress:
                # Queries that started unseen are still looked at now and then.
                progress.ended.wait(min(left, 1.0))
                progress.ended.clear()
                if time.monotonic() - flushed >= FLUSH:
                    progress.flush()
                    flushed = time.monotonic()
            else:
                time.sleep(min(left, LOOK))
            if end is not None and time.monotonic() >= end:
                break
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            query.stop()
        if progress:
            progress.settle()
            progress.flush()
            progress.detach()
