"""What the streams report while they run, kept as the table ``stream_progress``."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from retailflow.tables import Tables

TABLE = "stream_progress"

_SCHEMA = (
    "stream string, run_id string, event string, batch bigint, input_rows bigint, "
    "accepted bigint, rejected bigint, error_class string, message string, at timestamp"
)


class Progress(StreamingQueryListener):
    """A row for each start, batch and end of the queries in the sessions it is attached to.

    The events are ``started``, ``progress``, ``stopped`` and ``failed``; a failure has Spark's
    error class and the message. Rows wait in memory until :meth:`flush` stores them, which
    :func:`retailflow.streaming.jobs.wait` does now and then and at the end. Attach it before the
    queries start: what a query reports earlier is lost.
    """

    def __init__(self, tables: Tables, clock: Callable[[], datetime] | None = None):
        self.tables = tables
        self.clock = clock or (lambda: datetime.now(timezone.utc))
        self.ended = threading.Event()
        self._sessions: list[SparkSession] = []
        self._lock = threading.Lock()
        self._names: dict[str, str] = {}
        self._running: set[str] = set()
        self._rows: list[tuple] = []

    def attach(self, session: SparkSession) -> None:
        if not any(session is known for known in self._sessions):
            session.streams.addListener(self)
            self._sessions.append(session)

    def detach(self) -> None:
        for session in self._sessions:
            session.streams.removeListener(self)
        self._sessions.clear()

    def _note(self, run: str, event: str, *values) -> None:
        batch, rows, accepted, rejected, error, message = (*values, *[None] * 6)[:6]
        row = (
            self._names.get(run), run, event, batch, rows, accepted, rejected, error, message,
            self.clock(),
        )
        with self._lock:
            self._rows.append(row)

    def onQueryStarted(self, event) -> None:
        run = str(event.runId)
        self._names[run] = event.name
        self._running.add(run)
        self._note(run, "started")

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(f"{progress.name}_quality")
        counts = (seen["accepted"], seen["rejected"]) if seen else (None, None)
        self._note(
            str(progress.runId), "progress", progress.batchId, progress.numInputRows, *counts
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        failed = event.exception is not None
        error = (event.errorClassOnException or "UNCLASSIFIED") if failed else None
        self._note(run, "failed" if failed else "stopped", *[None] * 4, error, event.exception)
        self._running.discard(run)
        self.ended.set()

    def settle(self, seconds: float = 30) -> None:
        """Wait until the ends of all queries that were seen to start have been reported."""
        end = time.monotonic() + seconds
        while self._running and time.monotonic() < end:
            self.ended.wait(0.1)
            self.ended.clear()

    def flush(self) -> None:
        """Store the rows that wait."""
        with self._lock:
            rows, self._rows = self._rows, []
        if not rows:
            return
        tables, number = self.tables, self.tables.committed(TABLE) + 1
        frame = tables.spark.createDataFrame(rows, _SCHEMA)
        tables.write_batch(TABLE, tables.filed(frame, "at"), number)
        tables.commit(TABLE, number)
