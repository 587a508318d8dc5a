"""Stores of partition metadata: nine operations behind which a subscription keeps its progress.

``MemoryStore`` holds rows of one process; ``TableStore`` appends transitions to a folder of JSON files through Spark, so any store that Spark reaches
holds it and a restart finds it. Both keep a child's first row, raise KeyError for unknown tokens, and hand out copies. Changes inside ``with store.batch()`` are
appended together, at its end, or none of them.
"""

from __future__ import annotations

import copy
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timedelta, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.retry import RetryPolicy, retried
from ..functions.schemas import CREATED, FINISHED, METADATA, ROOT_TOKEN, RUNNING, SCHEDULED
from . import partitions


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Partition:
    """One row of metadata."""

    partition_token: str
    start_timestamp: datetime
    end_timestamp: datetime
    heartbeat_millis: int
    watermark: datetime
    parent_tokens: tuple[str, ...] = ()
    state: str = CREATED
    created_at: datetime = field(default_factory=_now)
    scheduled_at: datetime | None = None
    running_at: datetime | None = None
    finished_at: datetime | None = None

    @property
    def is_root(self) -> bool:
        return self.partition_token == ROOT_TOKEN


class PartitionStore(Protocol):
    def get_unfinished_min_watermark_partition(self) -> Partition | None: ...
    def get_interrupted_partitions(self) -> list[Partition]: ...
    def initialize_root_partition(self, start: datetime, end: datetime, heartbeat_millis: int) -> None: ...
    def get_schedulable_partitions(self, min_watermark: datetime) -> list[Partition]: ...
    def add_child_partitions(self, end: datetime, heartbeat_millis: int, start: datetime, children: Iterable[tuple[str, Iterable[str]]]) -> None: ...
    def update_to_scheduled(self, tokens: Iterable[str]) -> None: ...
    def update_to_running(self, token: str) -> None: ...
    def update_to_finished(self, token: str) -> None: ...
    def update_watermark(self, token: str, watermark: datetime) -> None: ...


class MemoryStore:
    def __init__(self) -> None:
        self.rows: dict[str, Partition] = {}
        self._lock = threading.RLock()

    @contextmanager
    def batch(self) -> Iterator[None]:
        """What changes inside changes together; after an error nothing of it has."""
        with self._lock:
            before = dict(self.rows)
            try:
                yield
            except BaseException:
                self.rows = before
                raise

    def _sorted(self, test: Callable[[Partition], bool], key: str) -> list[Partition]:
        with self._lock:
            return sorted((p for p in self.rows.values() if test(p)), key=lambda p: (getattr(p, key), p.partition_token))

    def get_unfinished_min_watermark_partition(self) -> Partition | None:
        return next(iter(self._sorted(lambda p: p.state != FINISHED, "watermark")), None)

    def get_interrupted_partitions(self) -> list[Partition]:
        return self._sorted(lambda p: p.state in (SCHEDULED, RUNNING), "watermark")

    def get_schedulable_partitions(self, min_watermark: datetime) -> list[Partition]:
        return self._sorted(lambda p: p.state == CREATED and p.start_timestamp >= min_watermark, "start_timestamp")

    def initialize_root_partition(self, start: datetime, end: datetime, heartbeat_millis: int) -> None:
        self._put([Partition(ROOT_TOKEN, start, end, heartbeat_millis, start)])

    def add_child_partitions(self, end: datetime, heartbeat_millis: int, start: datetime, children: Iterable[tuple[str, Iterable[str]]]) -> None:
        with self._lock:
            new = {t: Partition(t, start, end, heartbeat_millis, start, tuple(parents)) for t, parents in reversed(list(children)) if t not in self.rows}
            self._put(list(new.values()))

    def update_to_scheduled(self, tokens: Iterable[str]) -> None:
        self._change(list(tokens), state=SCHEDULED, scheduled_at=_now())

    def update_to_running(self, token: str) -> None:
        self._change([token], state=RUNNING, running_at=_now())

    def update_to_finished(self, token: str) -> None:
        self._change([token], state=FINISHED, finished_at=_now())

    def update_watermark(self, token: str, watermark: datetime) -> None:
        self._change([token], watermark=watermark)

    def _change(self, tokens: list[str], **values) -> None:
        with self._lock:
            self._put([replace(self.rows[t], **values) for t in tokens])

    def _put(self, rows: list[Partition]) -> None:
        with self._lock:
            self.rows.update((p.partition_token, copy.copy(p)) for p in rows)


class TableStore(MemoryStore):
    """The same, with each change appended to a folder as transition rows; opening the folder again finds the current ones."""

    schema = ", ".join(f"{f.name} {'timestamp_ntz' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}" for f in METADATA.fields) + ", version bigint"

    def __init__(self, spark: SparkSession, path: str, policy: RetryPolicy | None = None, sleep: Callable[[float], bool | None] = time.sleep):
        super().__init__()
        self.sleep, self.appends = sleep, 0
        self._waiting: dict[str, Partition] | None = None
        self.spark, self.path, self.policy = spark, path, policy or RetryPolicy()
        self.version = 0
        for r in self._log_rows():
            self.version = max(self.version, r["version"])
        if self.version:
            for r in partitions.current(self.log()).collect():  # a row per partition of the stream
                row = r.asDict()
                times = {k: v.replace(tzinfo=timezone.utc) for k, v in row.items() if isinstance(v, datetime)}
                self.rows[r.partition_token] = Partition(**row | times | {"parent_tokens": tuple(r.parent_tokens)})

    def _log_rows(self) -> list:
        try:
            return self.log().agg(F.coalesce(F.max("version"), F.lit(0)).alias("version")).collect()
        except Exception as e:  # a new folder
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def log(self) -> DataFrame:
        """All transitions; times are UTC without a zone, so no session setting moves them."""
        return self.spark.read.schema(self.schema).json(self.path)

    @contextmanager
    def batch(self) -> Iterator[None]:
        with self._lock:
            if self._waiting is not None:  # part of a batch around it
                yield
                return
            self._waiting = {}
            try:
                with super().batch():
                    yield
                    self._append(list(self._waiting.values()))
            finally:
                self._waiting = None

    def _put(self, rows: list[Partition]) -> None:
        with self._lock:
            if self._waiting is not None:
                self._waiting.update((p.partition_token, p) for p in rows)
            else:
                self._append(rows)
            super()._put(rows)

    def _frame(self, rows: list[Partition], version: int) -> DataFrame:
        def plain(p: Partition) -> tuple:
            values = asdict(p)
            return (*(v.astimezone(timezone.utc).replace(tzinfo=None) if isinstance(v := values[f], datetime) else list(v) if f == "parent_tokens" else v for f in partitions.FIELDS), version)

        return self.spark.createDataFrame([plain(p) for p in rows], self.schema).coalesce(1)

    def _write(self, frame: DataFrame) -> None:
        frame.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(self.path)

    def _append(self, rows: list[Partition]) -> None:
        """One write of all rows; another attempt after a failed one may leave a row twice, with the same version."""
        if not rows:
            return
        frame = self._frame(rows, self.version + 1)
        retried(lambda: self._write(frame), self.policy, self.sleep)
        self.version += 1
        self.appends += 1

    def compact(self, target: str, now: datetime | None = None, days: int = 1) -> None:
        """The current rows without long finished ones, written to another folder."""
        at = F.lit((now or _now()).astimezone(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
        kept = partitions.retained(partitions.current(self.log()), at, days).withColumn("version", F.lit(self.version).cast("long"))
        kept.coalesce(1).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(target)

    def trim(self, now: datetime | None = None, days: int = 1) -> None:
        """The log's files replaced by one with the current rows, without long finished ones: it is written first, then the others are deleted."""
        limit = (now or _now()) - timedelta(days=days)
        with self._lock:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            old = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")] if files.exists(folder) else []
            self.rows = {t: p for t, p in self.rows.items() if p.finished_at is None or p.finished_at >= limit}
            self._append(list(self.rows.values()))
            for path in old:
                files.delete(path, False)
            self.appends = 0

    @staticmethod
    def create(spark: SparkSession, path: str, name: str | None = None) -> None:
        """Makes the log's folder, if it isn't there, and with a name a table over it. Doing so again changes nothing."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        if name:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TableStore.schema}) USING json LOCATION '{path}'")
