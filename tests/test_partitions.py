from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.retry import RetryPolicy, StatusError, retried, retryable, status_of
from millrace.operators import acks, partitions
from millrace.operators.store import MemoryStore, TableStore

T0 = datetime(2023, 1, 1, tzinfo=timezone.utc)


def meta(spark):
    rows = [("created1", 0, "CREATED"), ("created2", -2, "CREATED"), ("scheduled", 1, "SCHEDULED"), ("running", 2, "RUNNING"), ("finished", -1, "FINISHED")]
    return spark.createDataFrame([(t, [], T0 + timedelta(seconds=s), state, T0 + timedelta(seconds=s)) for t, s, state in rows], "partition_token string, parent_tokens array<string>, start_timestamp timestamp, state string, watermark timestamp")


def names(df):
    return [r.partition_token for r in df.collect()]


def test_metadata_reads(spark):
    m = meta(spark)
    assert names(partitions.min_watermark(m)) == ["created2"]
    assert names(partitions.interrupted(m)) == ["scheduled", "running"]
    assert names(partitions.schedulable(m, T0)) == ["created1"]
    assert names(partitions.schedulable(m)) == ["created2", "created1"]
    assert names(partitions.min_watermark(m.where("state = 'FINISHED'"))) == []


def test_strict_parents_wait(spark):
    rows = [("a", [], "RUNNING"), ("b", [], "FINISHED"), ("c1", ["b"], "CREATED"), ("c2", ["a", "b"], "CREATED")]
    m = spark.createDataFrame([(t, p, T0, s, T0) for t, p, s in rows], "partition_token string, parent_tokens array<string>, start_timestamp timestamp, state string, watermark timestamp")
    assert names(partitions.schedulable(m)) == ["c1", "c2"]
    assert names(partitions.schedulable(m, strict_parents=True)) == ["c1"]


def test_children_keep_the_first_row_and_known_ones_stay(spark):
    found = spark.createDataFrame([("c1", ["p1"], T0, 1), ("c2", ["p1", "p2"], T0, 2), ("c2", ["other"], T0, 3), ("old", ["p1"], T0, 4)], "token string, parent_tokens array<string>, start_timestamp timestamp, at int")
    known = spark.createDataFrame([("old",)], "partition_token string")
    rows = partitions.new_children(found, known, F.lit(T0), F.lit(10_000), F.lit(T0), ["at"]).orderBy("partition_token").collect()
    assert [(r.partition_token, r.parent_tokens, r.state, r.watermark == r.start_timestamp) for r in rows] == [("c1", ["p1"], "CREATED", True), ("c2", ["p1", "p2"], "CREATED", True)]


def test_retention_boundary(spark):
    rows = [("a", None), ("b", T0), ("c", T0 - timedelta(seconds=1))]
    m = spark.createDataFrame(rows, "partition_token string, finished_at timestamp")
    assert sorted(names(partitions.retained(m, F.lit(T0 + timedelta(days=1))))) == ["a", "b"]


@pytest.mark.parametrize("kind", ["memory", "table"])
def test_store_walk(spark, tmp_path, kind):
    path = f"file://{tmp_path}/meta"
    store = MemoryStore() if kind == "memory" else TableStore(spark, path)
    assert store.get_unfinished_min_watermark_partition() is None
    store.initialize_root_partition(T0, T0 + timedelta(hours=1), 10_000)
    store.update_watermark("Parent0", T0 + timedelta(seconds=5, microseconds=123456))
    store.initialize_root_partition(T0, T0 + timedelta(hours=1), 10_000)
    assert store.get_unfinished_min_watermark_partition().watermark == T0
    store.add_child_partitions(T0 + timedelta(hours=1), 10_000, T0, [("c1", ["Parent0"]), ("c1", ["again"])])
    store.add_child_partitions(T0 + timedelta(hours=1), 10_000, T0 + timedelta(1), [("c1", ["again"]), ("c2", ["Parent0"])])
    assert store.rows["c1"].parent_tokens == ("Parent0",)
    assert [p.partition_token for p in store.get_schedulable_partitions(T0)] == ["Parent0", "c1", "c2"]
    store.update_to_scheduled(["Parent0", "c1"])
    store.update_to_running("c1")
    store.update_watermark("c1", T0 + timedelta(microseconds=7))
    store.update_to_finished("Parent0")
    if kind == "table":
        store = TableStore(spark, path)
    assert [(p.partition_token, p.state) for p in store.get_interrupted_partitions()] == [("c1", "RUNNING")]
    assert store.rows["c1"].watermark == T0 + timedelta(microseconds=7)
    assert store.rows["Parent0"].finished_at is not None and store.rows["Parent0"].watermark == T0
    with pytest.raises(KeyError):
        store.update_to_running("unknown")
    if kind == "table":
        store.compact(f"file://{tmp_path}/compact", now=datetime.now(timezone.utc) + timedelta(days=2))
        assert sorted(TableStore(spark, f"file://{tmp_path}/compact").rows) == ["c1", "c2"]


@pytest.mark.parametrize(
    ("policy", "attempt", "u", "ms"),
    [({}, 1, None, 100), ({}, 3, None, 400), ({"max_backoff": 0.3}, 4, None, 300), ({"multiplier": 0.5}, 3, None, 100), ({"min_backoff": 0.2, "max_backoff": 0.05}, 2, None, 200), ({"jitter": 0.2}, 1, 0.75, 110), ({"jitter": 0.2}, 1, 0.25, 90)],
)
def test_backoff(policy, attempt, u, ms):
    class Fixed:
        def random(self):
            return u

    p = RetryPolicy(**{"jitter": 0.0} | policy, rng=Fixed())
    assert p.backoff(attempt) * 1000 == pytest.approx(ms)


def test_a_failing_write_is_tried_again(spark, tmp_path, monkeypatch):
    waits, calls, plain = [], [], TableStore._write

    def write(self, frame):
        calls.append(1)
        if len(calls) < 3:
            raise errors[len(calls) - 1]
        plain(self, frame)

    monkeypatch.setattr(TableStore, "_write", write)
    store = TableStore(spark, f"file://{tmp_path}/meta", RetryPolicy(jitter=0.0), waits.append)
    errors = [ConnectionError("gone"), PySparkException("job failed: java.io.IOException: connection reset")]
    store.initialize_root_partition(T0, T0 + timedelta(hours=1), 10_000)
    assert len(calls) == 3 and waits == [0.1, 0.2]
    assert TableStore(spark, f"file://{tmp_path}/meta").rows["Parent0"].state == "CREATED"
    # what won't pass is raised at once, and nothing of it is kept
    calls.clear()
    errors = [PermissionError("no")]
    with pytest.raises(PermissionError):
        store.update_watermark("Parent0", T0 + timedelta(seconds=9))
    assert len(calls) == 1 and store.rows["Parent0"].watermark == T0
    calls.clear()
    errors = [ValueError("no")]
    with pytest.raises(ValueError), store.batch():
        store.update_to_scheduled(["Parent0"])
        assert store.get_interrupted_partitions()
    assert store.rows["Parent0"].state == "CREATED"


def test_status_codes():
    for error, code in ((None, "OK"), (StatusError("Aborted"), "Aborted"), (TimeoutError(), "DeadlineExceeded"), (OSError(), "Unavailable"), (FileNotFoundError(), "NotFound"), (ValueError(), "Unknown"), (PySparkException("Path exists already"), "InvalidArgument"), (PySparkException("java.net.SocketTimeoutException: x"), "DeadlineExceeded")):
        assert status_of(error) == code and retryable(error) == (code in ("Unavailable", "DeadlineExceeded"))


def test_a_batch_is_one_append_and_the_log_can_be_trimmed(spark, tmp_path):
    path = f"file://{tmp_path}/meta"
    TableStore.create(spark, path, "kept_partitions")
    TableStore.create(spark, path, "kept_partitions")
    store = TableStore(spark, path)
    with store.batch():
        store.initialize_root_partition(T0, T0 + timedelta(hours=1), 10_000)
        store.add_child_partitions(T0 + timedelta(hours=1), 10_000, T0, [(f"c{k}", ["Parent0"]) for k in range(5)])
        store.update_to_scheduled([f"c{k}" for k in range(5)])
        with store.batch():
            store.update_to_finished("c0")
    assert store.appends == 1 and len(list((tmp_path / "meta").glob("part-*.json"))) == 1
    assert {r.partition_token: r.state for r in spark.sql("SELECT partition_token, state FROM kept_partitions").collect()} == {"Parent0": "CREATED", "c0": "FINISHED"} | {f"c{k}": "SCHEDULED" for k in range(1, 5)}
    for k in range(1, 4):
        store.update_to_running(f"c{k}")
    store.trim()
    assert len(list((tmp_path / "meta").glob("part-*.json"))) == 1 and TableStore(spark, path).rows == store.rows
    store.trim(now=datetime.now(timezone.utc) + timedelta(days=2))
    assert sorted(TableStore(spark, path).rows) == ["Parent0", "c1", "c2", "c3", "c4"]
    spark.sql("DROP TABLE kept_partitions")


def test_retries_stop():
    calls = []

    def fail(code):
        def call():
            calls.append(code)
            raise StatusError(code)

        return call

    for code, n in (("Unavailable", 5), ("Aborted", 1)):
        calls.clear()
        with pytest.raises(StatusError):
            retried(fail(code), RetryPolicy(), lambda _: None)
        assert len(calls) == n
    calls.clear()
    with pytest.raises(StatusError):
        retried(fail("Internal"), RetryPolicy(), lambda _: True)
    assert len(calls) == 1 and not retryable(None)
    assert list(RetryPolicy(max_attempts=0).attempts(lambda _: None)) == [1]


def test_ack_prefix(spark):
    def run(rows):
        return acks.ack_watermark(spark.createDataFrame(rows, "token string, seq int, ts int, acked boolean"), ["token"], ["seq"]).first()

    assert run([("a", 0, 10, False), ("a", 1, 11, True)])[1:] == (0, 0, None)
    assert run([("a", 0, 30, True), ("a", 1, 20, True), ("a", 2, 40, None)])[1:] == (2, 2, 20)
    assert run([("a", 0, 30, True), ("a", 1, 20, True)])[1:] == (None, 2, 20)


def test_sequence_over_buckets(spark):
    rows = [("a", i // 3, i) for i in range(10)] + [("b", 5, 7)]
    df = acks.sequenced(spark.createDataFrame(rows, "token string, day int, at int"), ["token"], ["day", "at"], F.col("day"))
    assert sorted((r.token, r.at, r.seq) for r in df.collect()) == [("a", i, i) for i in range(10)] + [("b", 7, 0)]
