"""``python -m millrace.cli tail``: prints a change log's data changes as JSON lines; progress text goes to stderr."""

from __future__ import annotations

import argparse
import signal
import sys
import tempfile
from datetime import datetime

from pyspark.sql import SparkSession

from .operators.sinks import JsonLines
from .operators.store import MemoryStore, TableStore
from .streaming.subscriber import Config, Shutdown, Subscriber

#: Fixed value: how long an orderly end may take.
SHUTDOWN_SECONDS = 30.0


def time_of(text: str) -> datetime:
    value = datetime.fromisoformat(text.replace("Z", "+00:00"))
    if value.tzinfo is None:
        raise argparse.ArgumentTypeError("a time needs a zone")
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace tail", description=__doc__)
    p.add_argument("-d", "--database", required=True, help="folder of the change log")
    p.add_argument("-s", "--stream", required=True, help="name of the stream")
    p.add_argument("-t", "--metadata-table", help="folder that keeps progress; without it progress is kept in memory")
    p.add_argument("--metadata-database", help="parent folder of the progress folder")
    p.add_argument("--create-table", action="store_true", help="makes the progress folder and a table over it, if they aren't there")
    p.add_argument("--start", type=time_of)
    p.add_argument("--end", type=time_of)
    p.add_argument("--heartbeat-interval", type=float, default=0.0, help="seconds")
    p.add_argument("--max-inflight", type=int, default=0)
    p.add_argument("--priority", choices=("high", "medium", "low"), help="scheduler pool of the jobs")
    p.add_argument("--work", help="shared folder for tokens and checkpoint")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.priority:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", args.priority)
    table = f"{args.metadata_database}/{args.metadata_table}" if args.metadata_database and args.metadata_table else args.metadata_table
    if args.create_table:
        if not table:
            print("--create-table needs --metadata-table", file=sys.stderr)
            return 2
        TableStore.create(spark, table, "partition_metadata")
    store = TableStore(spark, table) if table else MemoryStore()
    work = args.work or spark.conf.get("spark.checkpoint.dir", None)
    if not work and not spark.sparkContext.master.startswith("local"):
        print("--work or spark.checkpoint.dir must name a folder that the driver and all executors share", file=sys.stderr)
        return 2
    work = work or tempfile.mkdtemp(prefix="millrace-")
    subscriber = Subscriber(Config(spark=spark, stream_name=args.stream, partition_storage=store, consumer=JsonLines(), path=args.database, work=work, start=args.start, end=args.end, heartbeat_interval=args.heartbeat_interval, max_inflight=args.max_inflight))

    def stop(*_) -> None:
        try:
            subscriber.shutdown(SHUTDOWN_SECONDS)
        except TimeoutError:
            subscriber.close()

    import threading

    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: threading.Thread(target=stop, daemon=True).start())
    print(f"reading {args.stream}", file=sys.stderr)
    try:
        subscriber.subscribe()
    except Shutdown:
        return 0
    except Exception as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main([a for a in sys.argv[1:] if a != "tail"]))
