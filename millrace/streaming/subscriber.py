"""Subscriptions: partitions are found, scheduled, read, given to a consumer and finished, with progress in a store.

One streaming query reads all scheduled partitions, each from its stored watermark (inclusive) to its end bound. A record past the bound, or the log's own
end, finishes a partition. Each subscription begins with a checkpoint of its own: where to go on is the store's alone to say, so a restart reads again
everything at or after the stored watermarks (at least once).

A partition's data records are given to the consumer in read order, ``max_inflight`` at a time; the next one follows as soon as one returns. A watermark covers the
acknowledged records before the first that isn't; heartbeats and child records are acknowledged at once, but wait behind earlier data. After each micro-batch all its progress
(children, watermarks, ended and newly scheduled partitions) is stored by one write. After an error the acknowledged prefixes are stored and the subscription ends.

The consumer runs

* on the executors, one task for each partition of a batch (``executor_consumer``, a picklable function), which is the way for many partitions;
* on the driver, one thread for each partition of a batch (``consumer``), for small streams and the command line;
* or as a function of each batch's data as a DataFrame (``batch_consumer``), all of it acknowledged when that returns.
"""

from __future__ import annotations

import inspect
import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import PartitionStore
from ..sources.changelog import ChangeLogSource, announce, retire

#: Fixed value: the end of a subscription without a bound.
OPEN_END = datetime(9999, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc)
#: Defaults.
HEARTBEAT_SECONDS, MAX_INFLIGHT, DISCOVERY_SECONDS = 10.0, 1, 1.0


class Shutdown(Exception):
    """The subscription ended by ``shutdown``."""


class Closed(Exception):
    """The subscription ended by ``close``."""


class Cancelled(Exception):
    """The subscription ended because its caller's event was set."""


class Record(NamedTuple):
    token: str
    seq: int
    kind: str
    ts: datetime
    record: str


class Context(NamedTuple):
    """What a consumer that takes two arguments gets beside the record: its partition, and whether the subscription was closed meanwhile."""

    token: str
    cancelled: Callable[[], bool]


#: A function of a record, or of a record and a Context; what it raises ends the subscription.
Consumer = Callable[..., object]


@dataclass
class Config:
    """``path`` is the change log's folder, ``work`` a shared folder for announcements and checkpoints. Zeros and Nones are defaults.

    ``poll_seconds`` is how often the log is looked at, ``max_bytes`` how much of a partition's file a micro-batch reads, ``cancelled`` an event of the caller.
    """

    spark: SparkSession | None = None
    stream_name: str = ""
    partition_storage: PartitionStore | None = None
    consumer: Consumer | None = None
    path: str = ""
    work: str = ""
    start: datetime | None = None
    end: datetime | None = None
    heartbeat_interval: float = 0.0
    max_inflight: int = 0
    partition_discovery_interval: float = 0.0
    batch_consumer: Callable[[DataFrame], object] | None = None
    executor_consumer: Consumer | None = None
    poll_seconds: float = 0.2
    max_bytes: int = 16 << 20
    cancelled: threading.Event | None = None


def validated(config: Config | None) -> Config:
    """The config with defaults; the first fault is raised."""
    if config is None:
        raise ValueError("config is required")
    for name, value in (("SparkSession", config.spark), ("StreamName", config.stream_name), ("PartitionStorage", config.partition_storage), ("Consumer", config.consumer or config.batch_consumer or config.executor_consumer)):
        if not value:
            raise ValueError(f"{name} is required")
    for name, value in (("MaxInflight", config.max_inflight), ("HeartbeatInterval", config.heartbeat_interval), ("PartitionDiscoveryInterval", config.partition_discovery_interval)):
        if value < 0:
            raise ValueError(f"{name} must be non-negative")
    return Config(
        **config.__dict__
        | {
            "start": config.start or datetime.now(timezone.utc), "end": config.end or OPEN_END, "heartbeat_interval": config.heartbeat_interval or HEARTBEAT_SECONDS,
            "max_inflight": config.max_inflight or MAX_INFLIGHT, "partition_discovery_interval": config.partition_discovery_interval or DISCOVERY_SECONDS,
        }
    )


def exit_error(closed: bool, error: BaseException | None, shut: bool, cancelled: bool = False) -> BaseException | None:
    """What ends a subscription: closing before an error before a shutdown before the caller's event before a normal end."""
    return Closed() if closed else error if error is not None else Shutdown() if shut else Cancelled() if cancelled else None


@dataclass
class Progress:
    """How far one partition came in one micro-batch."""

    token: str
    watermark: datetime | None = None
    ended: bool = False
    children: list[Record] = field(default_factory=list)
    error: BaseException | None = None


def consume(token: str, rows: Iterable[Record], consumer: Consumer, most: int = 1, cancelled: Callable[[], bool] = lambda: False) -> Progress:
    """A partition's records through the consumer, in order, at most ``most`` at a time; how far the acknowledged prefix reaches."""
    out, context = Progress(token), Context(token, cancelled)
    try:
        pair = sum(p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD) and p.default is p.empty for p in inspect.signature(consumer).parameters.values()) >= 2
    except (TypeError, ValueError):
        pair = False
    running: deque[tuple[Record, Future | None]] = deque()
    free = threading.Semaphore(most)

    def call(r: Record) -> None:
        try:
            consumer(r, context) if pair else consumer(r)
        finally:
            free.release()

    def settle(wait: bool) -> None:
        while running and out.error is None:
            r, future = running[0]
            if future is not None:
                if not wait and not future.done():
                    return
                out.error = future.exception()
                if out.error is not None:
                    return
            running.popleft()
            if r.kind == "end":
                out.ended = True
            else:
                out.watermark = r.ts

    with ThreadPoolExecutor(most) as pool:
        for r in rows:
            future = None
            if r.kind == "data":
                free.acquire()
                settle(False)
                if out.error is not None or cancelled():
                    break
                future = pool.submit(call, r)
            elif r.kind == "child":
                out.children.append(r)
            running.append((r, future))
            settle(False)
            if out.error is not None:
                break
        settle(True)
    return out


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[Record]:
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield Record(*row)


_PROGRESS = "token string, watermark timestamp, ended boolean, children string, error string"


def on_executors(rows: DataFrame, consumer: Consumer, most: int) -> list[Progress]:
    """``consume`` for each partition of a batch, in tasks; a row for each partition reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, own in groupby(_records(batches), lambda r: r.token):
            p = consume(token, own, consumer, most)
            children = json.dumps([[r.seq, r.ts.isoformat(), r.record] for r in p.children])
            cols = [pa.array([token]), pa.array([p.watermark], pa.timestamp("us", "UTC")), pa.array([p.ended]), pa.array([children]), pa.array([None if p.error is None else f"{type(p.error).__name__}: {p.error}"], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["token", "watermark", "ended", "children", "error"])

    dealt = rows.repartition("token").sortWithinPartitions("token", "seq").mapInArrow(run, _PROGRESS)
    out = []
    for r in dealt.collect():
        children = [Record(r.token, seq, "child", datetime.fromisoformat(ts), record) for seq, ts, record in json.loads(r.children)]
        out.append(Progress(r.token, r.watermark and r.watermark.astimezone(timezone.utc), r.ended, children, None if r.error is None else RuntimeError(r.error)))
    return out


def on_driver(rows: DataFrame, consumer: Consumer, most: int, cancelled: Callable[[], bool]) -> list[Progress]:
    """``consume`` for each partition of a batch, in threads."""
    plain = rows.withColumn("ts", F.unix_micros("ts")).orderBy("token", "seq").toLocalIterator()
    records = (Record(r.token, r.seq, r.kind, datetime.fromtimestamp(r.ts // 1_000_000, timezone.utc).replace(microsecond=r.ts % 1_000_000), r.record) for r in plain)
    with ThreadPoolExecutor(8) as pool:
        return [f.result() for f in [pool.submit(consume, token, list(own), consumer, most, cancelled) for token, own in groupby(records, lambda r: r.token)]]


def as_batch(rows: DataFrame, consumer: Callable[[DataFrame], object]) -> list[Progress]:
    """A batch's data given to the consumer as a DataFrame; how far each partition comes with it."""
    consumer(rows.where("kind = 'data'"))
    at = F.when(F.col("kind") != "end", F.col("seq"))
    last = rows.withColumn("ts", F.unix_micros("ts")).groupBy("token").agg(F.max_by("ts", at).alias("ts"), F.max(F.col("kind") == "end").alias("ended"), F.collect_list(F.when(F.col("kind") == "child", F.struct("seq", "ts", "record"))).alias("children"))

    def time_of(us: int | None) -> datetime | None:
        return None if us is None else datetime.fromtimestamp(us // 1_000_000, timezone.utc).replace(microsecond=us % 1_000_000)

    return [Progress(r.token, time_of(r.ts), r.ended, [Record(r.token, c.seq, "child", time_of(c.ts), c.record) for c in sorted(r.children, key=lambda c: c.seq)]) for r in last.collect()]


class Subscriber:
    #: Appends to a store after which its log is rewritten.
    TRIM_AFTER = 256

    def __init__(self, config: Config | None):
        self.config = validated(config)
        self._started, self._closed, self._shut = threading.Lock(), threading.Event(), threading.Event()
        self._over = threading.Event()  # every partition is finished
        # a batch, or a look for new partitions, has the store to itself; _batching is held while a batch's records are consumed
        self._store_lock, self._batching = threading.RLock(), threading.Lock()
        self._error: BaseException | None = None
        self._query = None
        self._reading: set[str] = set()

    def _cancelled(self) -> bool:
        return self.config.cancelled is not None and self.config.cancelled.is_set()

    def subscribe(self) -> None:
        """Blocks until every partition is finished; raises what ended it otherwise. A subscriber serves once."""
        if not self._started.acquire(blocking=False):
            raise RuntimeError("subscriber has already been started")
        try:
            self._run()
        except BaseException as e:  # the first error counts
            if not self._shut.is_set() and not self._closed.is_set():
                self._error = self._error or e
        error = exit_error(self._closed.is_set(), self._error, self._shut.is_set(), self._cancelled())
        if error is not None:
            raise error

    def shutdown(self, timeout: float = 30.0) -> None:
        """Lets ``subscribe`` return at once, waits until the records in flight are through and their progress is stored, then stops reading. TimeoutError if that takes longer;
        it goes on then until ``close``."""
        self._shut.set()
        if self._started.acquire(blocking=False):
            return  # never started
        if not self._batching.acquire(timeout=timeout):
            raise TimeoutError("shutdown timed out")
        self._batching.release()
        if self._query is not None:
            self._query.stop()

    def close(self) -> None:
        """Stops at once; what isn't stored comes again."""
        self._closed.set()
        if self._query is not None:
            self._query.stop()

    def _changes(self):
        store = self.config.partition_storage
        return store.batch() if hasattr(store, "batch") else nullcontext()

    def _read(self, partitions: list) -> None:
        """Has partitions read from their watermarks to their end bounds, those that aren't read yet."""
        store, new = self.config.partition_storage, [p for p in partitions if p.partition_token not in self._reading]
        for p in new:
            store.update_to_running(p.partition_token)
        announce(self._tokens, {p.partition_token: {"start": p.watermark.isoformat(), "end": p.end_timestamp.isoformat(), "heartbeat_millis": p.heartbeat_millis} for p in new})
        self._reading.update(p.partition_token for p in new)

    def _schedule(self) -> bool:
        """Schedules what can start; False when every partition is finished."""
        store = self.config.partition_storage
        with self._store_lock:
            low = store.get_unfinished_min_watermark_partition()
            if low is None:
                return False
            new = store.get_schedulable_partitions(low.watermark)
            if new:
                with self._changes():
                    store.update_to_scheduled([p.partition_token for p in new])
                    self._read(new)
            return True

    def _run(self) -> None:
        c = self.config
        store, spark = c.partition_storage, c.spark
        run = f"{c.work}/run-{uuid.uuid4().hex}"
        self._tokens = f"{run}/tokens"
        with self._store_lock, self._changes():
            if store.get_unfinished_min_watermark_partition() is None:
                store.initialize_root_partition(c.start, c.end, int(c.heartbeat_interval * 1000))
            self._read(store.get_interrupted_partitions())
        self._schedule()
        spark.dataSource.register(ChangeLogSource)
        rows = spark.readStream.format("changelog").option("path", c.path).option("tokens", self._tokens).option("max_bytes", str(c.max_bytes)).load()
        self._query = rows.writeStream.foreachBatch(self._batch).option("checkpointLocation", f"{run}/checkpoint").trigger(processingTime=f"{int(c.poll_seconds * 1000)} milliseconds").start()
        due = time.monotonic() + c.partition_discovery_interval
        while not (self._closed.is_set() or self._shut.is_set() or self._cancelled()):
            if self._query.awaitTermination(min(0.1, c.partition_discovery_interval)):  # raises what the query failed with
                break
            if time.monotonic() >= due and self._store_lock.acquire(blocking=False):  # a batch schedules by itself
                try:
                    due = time.monotonic() + c.partition_discovery_interval
                    if not self._schedule():
                        self._over.set()
                        break
                finally:
                    self._store_lock.release()
        if self._over.is_set():
            with self._batching:  # a batch that runs is let through, and a later one does nothing: stopping would interrupt its consumer
                pass
        if not self._shut.is_set():  # shutdown stops it when records in flight are through
            self._query.stop()

    def _batch(self, rows: DataFrame, _: int) -> None:
        c = self.config
        store = c.partition_storage
        with self._batching:
            if self._over.is_set():
                return
            if self._shut.is_set() or self._closed.is_set() or self._cancelled():
                raise Closed()
            rows.persist()
            try:
                if c.batch_consumer is not None:
                    done = as_batch(rows, c.batch_consumer)
                elif c.executor_consumer is not None:
                    done = on_executors(rows, c.executor_consumer, c.max_inflight)
                else:
                    done = on_driver(rows, c.consumer, c.max_inflight, self._closed.is_set)
                if self._closed.is_set():
                    raise Closed()
                with self._store_lock:
                    self._settle(done)
                for p in done:
                    if p.error is not None:
                        raise p.error
            except BaseException as e:
                self._error = self._error or (None if isinstance(e, Closed) else e)
                raise
            finally:
                rows.unpersist()

    def _settle(self, done: list[Progress]) -> None:
        """Stores a batch's progress: children, then watermarks, then ends, then what can start now; one write."""
        c = self.config
        store = c.partition_storage
        ended = [p.token for p in done if p.ended and p.error is None]
        with self._changes():
            for r in sorted((r for p in done for r in p.children), key=lambda r: (r.ts, r.token, r.seq)):
                children = json.loads(r.record)["child_partitions"]
                store.add_child_partitions(c.end, int(c.heartbeat_interval * 1000), r.ts.astimezone(timezone.utc), [(x["token"], x["parent_partition_tokens"]) for x in children])
            for p in done:
                if p.watermark is not None:
                    store.update_watermark(p.token, p.watermark)
            for token in ended:
                store.update_to_finished(token)
            self._schedule()
        retire(self._tokens, ended)
        if getattr(store, "appends", 0) >= self.TRIM_AFTER:
            store.trim()


def wait_until(test: Callable[[], bool], seconds: float, step: float = 0.1) -> bool:
    """Whether the test held within the time."""
    until = time.monotonic() + seconds
    while time.monotonic() < until:
        if test():
            return True
        time.sleep(step)
    return False
