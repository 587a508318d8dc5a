import io
import json
import threading
import time
from datetime import datetime, timedelta, timezone

import pytest

from millrace.operators.sinks import JsonLines
from millrace.operators.store import MemoryStore, TableStore
from millrace.sources import changelog
from millrace.streaming.subscriber import Cancelled, Closed, Config, Record, Shutdown, Subscriber, consume, exit_error, validated, wait_until
from millrace.streaming.tracker import tracked

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def lines(*kinds, start=0):
    return "".join(json.dumps({"kind": kind, "ts": at(start + s).isoformat(), "record": record}) + "\n" for s, (kind, record) in enumerate(kinds))


def child(*tokens, parents):
    return ("child", {"child_partitions": [{"token": t, "parent_partition_tokens": parents} for t in tokens]})


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "Parent0.jsonl").write_text(lines(("data", {"n": 1}), ("heartbeat", {}), child("c1", "c2", parents=["Parent0"]), ("end", {})))
    (folder / "c1.jsonl").write_text(lines(("data", {"n": 2}), child("c3", parents=["c1", "c2"]), ("end", {}), start=10))
    (folder / "c2.jsonl").write_text(lines(("data", {"n": 3}), child("c3", parents=["c1", "c2"]), ("end", {}), start=10))
    (folder / "c3.jsonl").write_text(lines(("data", {"n": 4}), ("data", {"n": 5}), ("end", {}), start=20))
    return folder


def config(spark, log, tmp_path, store, consumer, **more):
    return Config(**{"spark": spark, "stream_name": "s", "partition_storage": store, "consumer": consumer, "path": f"file://{log}", "work": f"file://{tmp_path}/work", "start": T0, "max_inflight": 10, "partition_discovery_interval": 0.1} | more)


def test_reads_all_partitions_once(spark, log, tmp_path):
    store, out = MemoryStore(), io.StringIO()
    subscriber = Subscriber(config(spark, log, tmp_path, store, JsonLines(out)))
    subscriber.subscribe()
    assert sorted(json.loads(x)["n"] for x in out.getvalue().splitlines()) == [1, 2, 3, 4, 5]
    assert {t: p.state for t, p in store.rows.items()} == dict.fromkeys(("Parent0", "c1", "c2", "c3"), "FINISHED")
    assert store.rows["c3"].watermark == at(21) and store.rows["c3"].start_timestamp == at(11)
    with pytest.raises(RuntimeError, match="already"):
        subscriber.subscribe()


@pytest.mark.parametrize("way", ["driver", "executors", "batch"])
def test_bounds(spark, tmp_path, way):
    """Records before the start and after the end aren't given to the consumer, and the end finishes the partition."""
    folder = tmp_path / "log"
    folder.mkdir()
    rows = [(0, "data"), (4, "data"), (10, "data"), (20, "end")]
    (folder / "Parent0.jsonl").write_text("".join(json.dumps({"kind": k, "ts": at(s).isoformat(), "record": {"n": s}}) + "\n" for s, k in rows))
    store, seen, out = MemoryStore(), [], tmp_path / "out"
    out.mkdir()

    def write(r):
        (out / f"{json.loads(r.record)['n']}").write_text("")

    ways = {"driver": {"consumer": lambda r: seen.append(json.loads(r.record)["n"])}, "executors": {"consumer": None, "executor_consumer": write}, "batch": {"consumer": None, "batch_consumer": lambda df: seen.extend(json.loads(r.record)["n"] for r in df.collect())}}
    Subscriber(config(spark, folder, tmp_path, store, **{"consumer": None} | ways[way], start=at(3), end=at(5))).subscribe()
    assert (seen or [int(f.name) for f in out.iterdir()]) == [4]
    assert store.rows["Parent0"].state == "FINISHED" and store.rows["Parent0"].watermark == at(4)


def test_error_keeps_positions_and_records_come_again(spark, log, tmp_path):
    store, seen = MemoryStore(), []

    def consume_(row):
        seen.append(row.record)
        if json.loads(row.record)["n"] == 5 and len([x for x in seen if x == row.record]) == 1:
            raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        Subscriber(config(spark, log, tmp_path, store, consume_)).subscribe()
    assert store.rows["c3"].state == "RUNNING" and store.rows["c3"].watermark == at(20)
    seen.append("again")
    Subscriber(config(spark, log, tmp_path, store, consume_)).subscribe()
    assert store.rows["c3"].state == "FINISHED"
    # from the stored watermark on, which is inclusive; nothing of finished partitions
    assert sorted(json.loads(x)["n"] for x in seen[seen.index("again") + 1 :]) == [4, 5]


def test_restart_from_a_stored_log_with_one_append_a_batch(spark, log, tmp_path):
    path, fail = f"file://{tmp_path}/meta", [True]

    def consume_(row):
        if json.loads(row.record)["n"] == 4 and fail:
            raise ValueError("no")
        seen.append(json.loads(row.record)["n"])

    seen, store = [], TableStore(spark, path)
    with pytest.raises(ValueError, match="no"):
        Subscriber(config(spark, log, tmp_path, store, consume_)).subscribe()
    # the start, three batches, and timed looks that found nothing: never an append for each partition
    assert store.appends <= 6
    fail.clear()
    again = TableStore(spark, path)
    assert again.rows["c3"].state == "RUNNING"
    Subscriber(config(spark, log, tmp_path, again, consume_)).subscribe()
    assert sorted(seen) == [1, 2, 3, 4, 5] and {p.state for p in TableStore(spark, path).rows.values()} == {"FINISHED"}


def test_a_log_that_grows_is_read_on(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    file = folder / "Parent0.jsonl"
    file.write_text(lines(("data", {"n": 1})) + '{"kind": "data", "ts": "2024-01')
    store, seen = MemoryStore(), []
    thread = threading.Thread(target=Subscriber(config(spark, folder, tmp_path, store, lambda r: seen.append(json.loads(r.record)["n"]))).subscribe)
    thread.start()
    assert wait_until(lambda: seen == [1], 60)
    file.write_text(lines(("data", {"n": 1}), ("data", {"n": 2}), ("end", {})))
    thread.join(60)
    assert not thread.is_alive() and seen == [1, 2]


def test_what_a_trigger_reads(tmp_path, monkeypatch):
    """After the first one, a trigger reads about what is new of a file, not the file."""
    folder, got = tmp_path / "log", []
    folder.mkdir()
    file = folder / "a.jsonl"
    body = "".join(lines(("data", {"n": k}), start=k) for k in range(3000))
    file.write_text(body)
    plain = changelog.piece
    monkeypatch.setattr(changelog, "piece", lambda uri, p, n: got.append(n) or plain(uri, p, n))
    changelog.announce(f"file://{tmp_path}/tokens", {"a": {"start": at(5).isoformat(), "end": at(3001).isoformat()}})
    reader = changelog.ChangeLogReader({"path": f"file://{folder}", "tokens": f"file://{tmp_path}/tokens", "max_bytes": "20000"})
    start, rows = reader.initialOffset(), []
    while (end := reader.latestOffset()) != start:
        rows += [r for p in reader.partitions(start, end) for r in reader.read(p)]
        start = end
    assert [json.loads(r[4])["n"] for r in rows] == list(range(5, 3000)) and sum(got) < 3 * len(body)
    got.clear()
    assert reader.latestOffset() == start and not got
    with file.open("a") as f:
        f.write(lines(("data", {"n": 3000}), start=3000) + lines(("data", {"n": 9}), start=3002) + lines(("data", {"n": 9}), start=3003))
    end = reader.latestOffset()
    assert [(r[2], json.loads(r[4])) for p in reader.partitions(start, end) for r in reader.read(p)] == [("data", {"n": 3000}), ("end", {})]
    assert sum(got) < 2000
    changelog.retire(f"file://{tmp_path}/tokens", ["a"])
    assert reader.latestOffset() == {}


def test_a_line_longer_than_a_trigger_reads(tmp_path):
    file = tmp_path / "a.jsonl"
    text = "x" * 200_000
    file.write_text(lines(("data", {"t": text})) + lines(("data", {"t": "y"})) + "unfinished")
    size, first = file.stat().st_size, len(lines(("data", {"t": text})))
    assert changelog.line_end(f"file://{file}", 0, 1000, size) == first
    assert changelog.line_end(f"file://{file}", first, size, size) == size - len("unfinished")
    assert changelog.line_end(f"file://{file}", size - len("unfinished"), size, size) == size - len("unfinished")
    assert [len(x) for _, x in changelog.lines(f"file://{file}", 0, size - len("unfinished"), 1000)] == [first - 1, size - len("unfinished") - first - 1]


def test_envelopes_in_the_stream(tmp_path):
    row = {"kind": "envelope", "heartbeat_record": [{"timestamp": at(1).isoformat()}], "child_partitions_record": [{"start_timestamp": at(2).isoformat(), "child_partitions": []}], "data_change_record": [{"commit_timestamp": at(3).isoformat(), "n": 1}, {"commit_timestamp": at(4).isoformat(), "n": 2}]}
    assert [(k, t) for k, t, _ in changelog.records(row)] == [("data", at(3)), ("data", at(4)), ("heartbeat", at(1)), ("child", at(2))]


def rows_of(*kinds):
    return [Record("p", k, kind, at(k), "{}") for k, kind in enumerate(kinds)]


def test_in_flight_bound():
    now, most, lock = [0], [0], threading.Lock()

    def slow(r, context):
        assert context.token == "p" and not context.cancelled()
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1

    for bound in (1, 3):
        most[0] = 0
        got = consume("p", rows_of(*["data"] * 12, "end"), slow, bound)
        assert most[0] == bound and (got.watermark, got.ended, got.error) == (at(11), True, None)
    # the next record follows when one returns, not with the next batch
    began = time.monotonic()
    consume("p", rows_of(*["data"] * 50), lambda r: None, 1)
    assert time.monotonic() - began < 1


def test_watermark_is_that_of_the_acknowledged_prefix():
    def fails_at(k):
        def call(r):
            if r.seq == k:
                time.sleep(0.05)
                raise ValueError("no")

        return call

    for bound in (1, 4):
        got = consume("p", rows_of("data", "heartbeat", "data", "heartbeat", "data", "end"), fails_at(2), bound)
        assert got.watermark == at(1) and not got.ended and isinstance(got.error, ValueError)
        assert consume("p", rows_of("data", "heartbeat"), fails_at(0), bound).watermark is None
    assert consume("p", rows_of("heartbeat", "child"), fails_at(9)).watermark == at(1)


def test_shutdown_returns_at_once_and_waits_for_records_in_flight(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "Parent0.jsonl").write_text(lines(("data", {"n": 1})))
    store, seen, ended, go = MemoryStore(), [], [], threading.Event()

    def consume_(r):
        seen.append(r.record)
        go.wait(60)

    subscriber = Subscriber(config(spark, folder, tmp_path, store, consume_))

    def run():
        try:
            subscriber.subscribe()
        except Shutdown as e:
            ended.append(e)

    thread = threading.Thread(target=run)
    thread.start()
    assert wait_until(lambda: bool(seen), 90)
    with pytest.raises(TimeoutError):
        subscriber.shutdown(0.5)
    thread.join(10)  # while the consumer still runs
    assert len(ended) == 1 and store.rows["Parent0"].watermark == T0
    go.set()
    subscriber.shutdown(60)
    assert store.rows["Parent0"].state == "RUNNING" and store.rows["Parent0"].watermark == at(0)
    assert not subscriber._query.isActive


def test_close_and_cancelling(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "Parent0.jsonl").write_text(lines(("data", {"n": 1})))
    for kind in (Closed, Cancelled):
        seen, ended, event = [], [], threading.Event()
        subscriber = Subscriber(config(spark, folder, tmp_path, MemoryStore(), lambda r, seen=seen: seen.append(1), cancelled=event))

        def run(subscriber=subscriber, ended=ended):
            try:
                subscriber.subscribe()
            except Exception as e:
                ended.append(type(e))

        thread = threading.Thread(target=run)
        thread.start()
        assert wait_until(lambda seen=seen: bool(seen), 90)
        subscriber.close() if kind is Closed else event.set()
        thread.join(60)
        assert ended == [kind]


def test_validation():
    store, consumer = MemoryStore(), lambda r: None
    with pytest.raises(ValueError, match="config is required"):
        Subscriber(None)
    full = {"spark": object(), "stream_name": "s", "partition_storage": store, "consumer": consumer}
    for field, name in (("spark", "SparkSession"), ("stream_name", "StreamName"), ("partition_storage", "PartitionStorage"), ("consumer", "Consumer")):
        with pytest.raises(ValueError, match=f"{name} is required"):
            validated(Config(**full | {field: None}))
    for field, name in (("max_inflight", "MaxInflight"), ("heartbeat_interval", "HeartbeatInterval"), ("partition_discovery_interval", "PartitionDiscoveryInterval")):
        with pytest.raises(ValueError, match=f"{name} must be non-negative"):
            validated(Config(**full | {field: -1}))
    done = validated(Config(**full))
    assert (done.max_inflight, done.heartbeat_interval, done.partition_discovery_interval, done.end.year) == (1, 10.0, 1.0, 9999)


def test_exit_order():
    e = ValueError()
    assert exit_error(False, None, False) is None
    assert isinstance(exit_error(False, None, True), Shutdown)
    assert exit_error(False, e, True) is e
    assert isinstance(exit_error(True, e, True), Closed)
    assert isinstance(exit_error(False, None, False, True), Cancelled) and isinstance(exit_error(False, None, True, True), Shutdown)


def test_tracker_keeps_up_with_any_order(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "token string, seq bigint, ts timestamp, acked boolean"
    steps = [[("a", 0, True), ("a", 2, True), ("b", 1, True)], [("a", 1, True), ("b", 0, False)], [("a", 3, True), ("b", 2, True), ("a", 0, True)]]
    for n, rows in enumerate(steps):
        spark.createDataFrame([(t, s, T0 + timedelta(seconds=s), k) for t, s, k in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/{n}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(folder))
    q = tracked(stream).writeStream.format("memory").queryName("tracked").outputMode("update").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    last = {r.token: (r.next_seq, r.watermark.replace(tzinfo=timezone.utc)) for r in spark.table("tracked").orderBy("next_seq").collect()}
    assert last == {"a": (4, T0 + timedelta(seconds=3))}


def test_a_batch_after_the_last_partition_ended_does_nothing():
    got = []
    own = Subscriber(Config(spark=object(), stream_name="s", partition_storage=MemoryStore(), consumer=got.append))
    own._over.set()
    own._batch(None, 0)
    assert got == [] and own._error is None
