"""Change logs: derived from the events table, as envelopes, and as a streaming source over a folder.

The folder has one JSON-lines file per partition, ``<token>.jsonl``, which may grow while it is read, in read order. A line is
``{"kind": "data" | "heartbeat" | "child" | "end", "ts": text, "record": object}``, or an envelope ``{"kind": "envelope", "data_change_record": [...], "heartbeat_record": [...],
"child_partitions_record": [...]}``, whose records are read in this order. ``end`` closes a partition. Which partitions are read, and from when to when, is
listed in a second folder (``announce``, ``retire``), so that partitions found by a batch are read by later ones.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators import acks

#: Order in which an envelope's records are read.
KIND_RANK = {"data": 0, "heartbeat": 1, "child": 2}


def derived(events: DataFrame, tokens: int = 8) -> DataFrame:
    """A change log from the events table: token, kind, mod_type and acked of each event. It is read in order of (ts, event_id)."""
    kind = F.when(F.col("event_type").isin("signup", "click", "purchase"), "data").when(F.col("event_type") == "view", "heartbeat").otherwise("child")
    mod = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "click", "UPDATE").when(F.col("event_type") == "purchase", "DELETE")
    acked = ~((F.col("event_type") == "purchase") & (F.col("value") > 180))
    token = F.concat(F.lit("p"), (F.col("user_id") % tokens).cast("string"))
    return events.select("event_id", "ts", "user_id", "value", "props", token.alias("token"), kind.alias("kind"), mod.alias("mod_type"), acked.alias("acked"))


def derived_metadata(log: DataFrame) -> DataFrame:
    """Metadata of the derived log: p0 and p1 finished, p2 and p3 running, p4 scheduled, the rest created."""
    state = F.when(F.col("token").isin("p0", "p1"), "FINISHED").when(F.col("token").isin("p2", "p3"), "RUNNING").when(F.col("token") == "p4", "SCHEDULED").otherwise("CREATED")
    rows = log.groupBy("token").agg(F.min("ts").alias("start_timestamp"), F.max("ts").alias("last"))
    return rows.select(F.col("token").alias("partition_token"), "start_timestamp", state.alias("state"), F.when(state == "CREATED", F.col("start_timestamp")).otherwise(F.col("last")).alias("watermark"), F.when(state == "FINISHED", F.col("last")).alias("finished_at"))


def read_partition(log: DataFrame, token: str, start: Column, end: Column) -> DataFrame:
    """One partition's records from its resume position (inclusive) to the end bound; the filters reach the scan."""
    return log.where((F.col("token") == token) & (F.col("ts") >= start) & (F.col("ts") <= end))


def statement(stream: str) -> str:
    """The text by which a database is asked for a stream's records. Its names are fixed values."""
    return f"SELECT ChangeRecord FROM READ_{stream} (@startTimestamp, @endTimestamp, @partitionToken, @heartbeatMilliseconds)"


def envelopes(log: DataFrame, by: list[str], bucket: Column) -> DataFrame:
    """(by, bucket, data, heartbeat, child): records of a bucket as three arrays in read order."""
    item = F.struct("ts", "event_id")
    arrays = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, item))).alias(k) for k in KIND_RANK]
    return log.groupBy(*by, bucket.alias("bucket")).agg(*arrays)


def demultiplexed(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, bucket, kind, ts, event_id, seq): records of envelopes, all data first, then heartbeats, then children, numbered in each partition."""
    parts = [rows.select(*by, "bucket", F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.posexplode(kind).alias("pos", "item")) for kind, rank in KIND_RANK.items()]
    flat = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sizes = rows.select(*by, "bucket", sum((F.size(k) for k in KIND_RANK), F.lit(0)).alias("_n"), *(F.size(k).alias(f"_n{r}") for k, r in KIND_RANK.items()))
    # an envelope's first number is the sum of earlier ones' sizes; inside, positions follow from the arrays
    first = F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.withColumn("_first", first)
    before = F.when(F.col("rank") == 0, F.lit(0)).when(F.col("rank") == 1, F.col("_n0")).otherwise(F.col("_n0") + F.col("_n1"))
    return flat.join(placed, [*by, "bucket"]).select(*by, "bucket", "kind", F.col("item.ts").alias("ts"), F.col("item.event_id").alias("event_id"), (F.col("_first") + before + F.col("pos")).cast("long").alias("seq"))


def numbered(log: DataFrame, by: list[str], bucket: Column, order: list[str]) -> DataFrame:
    """``log`` with seq as if its records came in envelopes by bucket: all data of a bucket first, then heartbeats, then children. Nothing is gathered in arrays."""
    rank = F.when(F.col("kind") == "data", 0).when(F.col("kind") == "heartbeat", 1).otherwise(2)
    return acks.sequenced(log, by, order, F.struct(bucket.alias("bucket"), rank.alias("rank")))


class TokenRange(InputPartition):
    """Whole lines of a partition's file between two byte positions, and the bounds of its records' times."""

    def __init__(self, token: str, start: int, end: int, bounds: dict):
        self.token, self.start, self.end, self.bounds = token, start, end, bounds


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def sizes(uri: str) -> dict[str, int]:
    """Names and sizes of a folder's files, by one listing."""
    from pyarrow import fs

    store, path = _store(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return {f.base_name: f.size for f in found if f.type == fs.FileType.File and not f.base_name.startswith(".")}


def piece(uri: str, at: int, n: int) -> bytes:
    """Some bytes of a file."""
    store, path = _store(uri)
    with store.open_input_file(path) as f:
        return f.read_at(n, at)


def line_end(uri: str, at: int, until: int, size: int, step: int = 1 << 16) -> int:
    """The end of the last whole line that ends after ``at`` and not after ``until``; of a line that is longer, its own end; ``at`` if it isn't finished."""
    low = until
    while low > at:
        low = max(at, low - step)
        found = piece(uri, low, min(step, until - low)).rfind(b"\n")
        if found >= 0:
            return low + found + 1
    while until < size:
        found = piece(uri, until, step).find(b"\n")
        if found >= 0:
            return until + found + 1
        until += step
    return at


def lines(uri: str, at: int, until: int, step: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the whole lines between two positions, read piece by piece."""
    left = b""
    for low in range(at, until, step):
        *whole, left = (left + piece(uri, low, min(step, until - low))).split(b"\n")
        for line in whole:
            yield at, line
            at += len(line) + 1


#: Where each kind of an envelope's records has its time.
_TIMES = {"data": ("data_change_record", "commit_timestamp"), "heartbeat": ("heartbeat_record", "timestamp"), "child": ("child_partitions_record", "start_timestamp")}


def records(row: dict) -> Iterator[tuple[str, datetime, str]]:
    """(kind, time, record) of a line: one, or those of an envelope in their order."""
    if row["kind"] != "envelope":
        yield row["kind"], datetime.fromisoformat(row["ts"]), json.dumps(row.get("record") or {})
        return
    for kind, (name, at) in _TIMES.items():
        for record in row.get(name) or []:
            yield kind, datetime.fromisoformat(record[at]), json.dumps(record)


class ChangeLogSource(DataSource):
    """Streaming source ``changelog``: options path, tokens (folder of announcements), max_bytes (of a partition's file in a batch).

    A record's seq is its line's position in the file (and its place in an envelope), so it grows in read order. Records before a partition's start bound are
    passed over; the first one after its end bound, or an ``end`` line, gives a row of kind ``end``.
    """

    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return "token string, seq bigint, kind string, ts timestamp, record string"

    def streamReader(self, schema) -> ChangeLogReader:
        return ChangeLogReader(self.options)


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.tokens, self.most = options["path"], options["tokens"], int(options.get("max_bytes", str(16 << 20)))
        self.reached: dict[str, int] = {}
        self.bounds: dict[str, dict] = {}
        self.closed: set[str] = set()
        self._seen: set[str] = set()

    def _announced(self) -> None:
        """Reads the announcements that weren't read before; they never change."""
        found = sizes(self.tokens)
        for name in sorted(found.keys() - self._seen):
            news = json.loads(piece(f"{self.tokens}/{name}", 0, found[name]))
            self.bounds |= news.get("open", {})
            self.closed.update(news.get("closed", []))
            self._seen.add(name)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self._announced()
        there, out = sizes(self.path), {}
        for token in self.bounds.keys() - self.closed:
            at, size = self.reached.get(token, 0), there.get(f"{token}.jsonl", 0)
            out[token] = line_end(f"{self.path}/{token}.jsonl", at, min(size, at + self.most), size) if size > at else at
        self.reached |= out
        return out

    def partitions(self, start: dict, end: dict) -> list[TokenRange]:
        self._announced()
        for token, at in end.items():
            self.reached[token] = max(self.reached.get(token, 0), at)
        return [TokenRange(t, start.get(t, 0), n, self.bounds.get(t, {})) for t, n in sorted(end.items()) if n > start.get(t, 0)]

    def read(self, partition: TokenRange) -> Iterator[tuple]:
        low, high = (datetime.fromisoformat(x) if (x := partition.bounds.get(k)) else None for k in ("start", "end"))
        for at, line in lines(f"{self.path}/{partition.token}.jsonl", partition.start, partition.end):
            for n, (kind, ts, record) in enumerate(records(json.loads(line)) if line.strip() else ()):
                if kind == "end" or high is not None and ts > high:
                    yield partition.token, at + n, "end", high if kind != "end" else ts, "{}"
                    return
                if low is None or ts >= low:
                    yield partition.token, at + n, kind, ts, record

    def commit(self, end: dict) -> None:
        pass


def write_log(rows: DataFrame, folder: str, order: list[str]) -> None:
    """Rows (token, kind, ts, record as JSON, and the order's columns) as a change log: a file for each token, closed by an end line. Times without a zone are UTC."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    lines_ = rows.select("token", *order, F.concat(F.lit('{"kind":"'), F.col("kind"), F.lit('","ts":"'), text, F.lit('","record":'), F.col("record"), F.lit("}\n")).alias("_line"), text.alias("_ts"))

    def run(batches):
        import pyarrow as pa

        token, out, last = None, None, None
        store, path = _store(folder)
        store.create_dir(path, recursive=True)

        def close() -> None:
            out.write(json.dumps({"kind": "end", "ts": last, "record": {}}).encode() + b"\n")
            out.close()

        for b in batches:
            for t, line, last_ in zip(*(b.column(c).to_pylist() for c in ("token", "_line", "_ts")), strict=True):
                if t != token:
                    if out is not None:
                        close()
                    token, out = t, store.open_output_stream(f"{path}/{t}.jsonl")
                out.write(line.encode())
                last = last_
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["token"])

    lines_.repartition("token").sortWithinPartitions("token", *order).mapInArrow(run, "token string").count()


def _say(tokens: str, what: dict) -> None:
    store, path = _store(tokens)
    store.create_dir(path, recursive=True)
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
    with store.open_output_stream(f"{path}/.{name}") as f:
        f.write(json.dumps(what).encode())
    store.move(f"{path}/.{name}", f"{path}/{name}")


def announce(tokens: str, partitions: dict[str, dict]) -> None:
    """Lists partitions as to be read from the next batch on, each with its bounds (start, end, heartbeat_millis; times as text, both inclusive)."""
    if partitions:
        _say(tokens, {"open": partitions})


def retire(tokens: str, names: list[str]) -> None:
    """Lists partitions as read to their ends."""
    if names:
        _say(tokens, {"closed": names})
