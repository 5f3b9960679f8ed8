"""Command line for spark-submit; the only place that reads the clock for ``as_of``.

    spark-submit --py-files retailflow.zip retailflow/__main__.py summary --root hdfs:///shop
    python -m retailflow stream --root /tmp/shop --files inbox
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from retailflow import files
from retailflow.plans import scheduled
from retailflow.plans.archive import archive_transactions
from retailflow.schemas import EVENTS
from retailflow.session import configure, scratch_folder
from retailflow.sources.events import read_files, read_topic
from retailflow.streaming import jobs
from retailflow.streaming.progress import Progress
from retailflow.tables import CURRENT, GATHERED, Tables


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--root", required=True, help="folder of the tables, shared by all")
    common.add_argument("--period", choices=("day", "month", "year"), help="for new tables")
    common.add_argument(
        "--rebalance", action="store_true", help="shuffle batches to their folders (backfills)"
    )
    timed = argparse.ArgumentParser(add_help=False, parents=[common])
    timed.add_argument("--as-of", type=datetime.fromisoformat, help="default: now")
    parser = argparse.ArgumentParser(prog="retailflow")
    commands = parser.add_subparsers(dest="command", required=True)
    stream = commands.add_parser("stream", parents=[common])
    origin = stream.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers", help="read the topics of these brokers")
    origin.add_argument("--files", help="read <folder>/<kind>/ as JSON lines")
    stream.add_argument("--kinds", nargs="+", choices=list(EVENTS), default=list(EVENTS))
    stream.add_argument("--running", action="store_true", help="all-time totals as well")
    stream.add_argument(
        "--state-partitions", type=int, default=jobs.STATE_PARTITIONS,
        help="of the all-time totals; the first start fixes it",
    )
    stream.add_argument("--seconds", type=float, help="default: drain what is there and stop")
    stream.add_argument("--every", default="1 minute", help="batch interval with --seconds")
    stream.add_argument("--keep-files", action="store_true", help="leave read files in place")
    stream.add_argument(
        "--daily-keys", action="store_true", help="store what summary --merged reads"
    )
    stream.add_argument("--limit", help="records (topics) or files per batch; bounds a backlog")
    load = commands.add_parser("load-coordinates", parents=[common])
    load.add_argument("--csv", required=True)
    summary = commands.add_parser("summary", parents=[timed])
    summary.add_argument(
        "--merged", action="store_true", help="from the keys that stream --daily-keys stores"
    )
    for name in ("activity", "archive"):
        commands.add_parser(name, parents=[timed])
    alert = commands.add_parser("alert", parents=[timed])
    alert.add_argument("--threshold", type=int, default=scheduled.LARGE_ORDER)
    alert.add_argument("--lines", type=int, default=scheduled.LINES_PER_MESSAGE)
    commands.add_parser("compact", parents=[common])
    return parser.parse_args(words)


def stream(tables: Tables, given: argparse.Namespace) -> None:
    def source(kind: str) -> jobs.Source:
        if given.servers:
            limit = {"maxOffsetsPerTrigger": given.limit} if given.limit else {}
            return lambda spark: read_topic(spark, kind, given.servers, **limit)
        limit = {"maxFilesPerTrigger": given.limit} if given.limit else {}
        # Two queries read the transactions then: neither may move what the other has to read.
        shared = given.running and kind == "transactions"
        archive = None if given.keep_files or shared else tables.read_folder(kind)
        return lambda spark: read_files(
            spark, f"{given.files}/{kind}", archive=archive, **limit
        )

    trigger = {"processingTime": given.every} if given.seconds else None
    sources = {kind: source(kind) for kind in given.kinds}
    progress = Progress(tables)
    started = jobs.start_all(
        tables,
        sources,
        given.running,
        trigger=trigger,
        partitions=given.state_partitions,
        progress=progress,
        daily=given.daily_keys,
    )
    jobs.wait(started, given.seconds, progress)


def show(frame: DataFrame) -> None:
    """Print a report, a row at a time."""
    for row in frame.toLocalIterator():
        print(*row, sep="\t")


def main(words: list[str] | None = None) -> None:
    given = arguments(words)
    spark = configure(SparkSession.builder.appName("retailflow").getOrCreate())
    tables = Tables(spark, given.root, given.period, given.rebalance)
    tables.create()
    as_of = getattr(given, "as_of", None) or jobs.utc_now()
    match given.command:
        case "stream":
            stream(tables, given)
        case "load-coordinates":
            print(scheduled.load_coordinates(tables, given.csv))
        case "summary":
            rows = tables.read("transaction_data")
            show(scheduled.export_daily_summary(tables, rows, as_of, given.merged))
        case "activity":
            show(scheduled.activity_update(tables, as_of))
        case "alert":
            folder = scratch_folder(spark, "alert")
            alert = scheduled.large_order_check(
                tables, as_of, folder, given.threshold, given.lines
            )
            print(alert.count())  # the messages are in the table alerts
            files.delete(spark, folder)
        case "archive":
            print(archive_transactions(tables, as_of))
        case "compact":
            for name in CURRENT:
                tables.compact(name)
            for name in GATHERED:
                tables.gather(name)


if __name__ == "__main__":
    main()
