"""Moving transactions past the retention time out of the live table."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from retailflow import files
from retailflow.functions.timing import RETENTION, archive_cutoff, instant, older_than, period_end
from retailflow.session import setting
from retailflow.tables import Tables

READ_PART = "32m"


def archive_transactions(
    tables: Tables, as_of: datetime, retention: timedelta = RETENTION
) -> int:
    """Move old rows to the archive and return the run's number.

    The run's marker publishes both halves at once: from then on readers of the live
    table skip what readers of the archive see. Nothing of the live table is
    rewritten; folders that hold only archived rows are deleted one run later. A row
    takes along the name and e-mail it was logged with, so no join is needed.
    A run that fails before its marker is repeated under the same number.
    """
    cutoff = archive_cutoff(as_of, retention)
    previous = tables.archive_run()
    if previous is not None:
        if cutoff.replace(tzinfo=None) < previous[0]:
            raise ValueError("an archive run cannot go back in time")
        drop_archived(tables, *previous)
    run = tables.committed("archive") + 1
    through = tables.committed("transactions")
    moved = older_than(tables.live_transactions(), instant(cutoff)).filter(
        F.col("batch_id") <= through
    )
    # Rows are sorted by period as they are written: parts this small stay in memory.
    with setting(tables.spark, "spark.sql.files.maxPartitionBytes", READ_PART):
        tables.write_batch("archived_transactions", moved.drop("batch_id"), run)
    state = tables.spark.range(1).select(
        instant(cutoff).alias("cutoff"), F.lit(through).alias("through_batch")
    )
    tables.write_batch("archive_runs", state, run)
    tables.commit("archive", run)
    return run


def drop_archived(tables: Tables, cutoff: datetime, through: int) -> int:
    """Delete the live folders whose rows are all archived; the cutoff's period stays.

    Gathering keeps the batches, and so the folders looked at, few.
    """
    column, log = tables.period_column, tables.path("transactions_log")
    below = f"status=accepted/{column}=*"
    folders = files.matches(tables.spark, f"{log}/batch_id=*/{below}")
    folders += files.matches(
        tables.spark, f"{tables.gathered_path('transactions_log')}/{below}/through=*"
    )
    dropped = 0
    for folder in folders:
        batch = re.search(r"(?:batch_id|through)=(\d+)", folder)
        start = re.search(rf"{column}=(\d{{4}}-\d\d-\d\d)", folder)
        if not batch or not start or int(batch[1]) > through:
            continue
        if period_end(date.fromisoformat(start[1]), tables.period) <= cutoff.date():
            files.delete(tables.spark, folder)
            dropped += 1
    return dropped
