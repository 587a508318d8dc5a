"""Queries over the provided tables, each with the same result in SQL. The change log is derived from the events table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode, retry
from ..functions.schemas import COLUMN_TYPE, DATA_CHANGE, FINISHED, RUNNING, SCHEDULED, TYPE_CODES
from ..operators import acks, partitions, store
from ..sources import changelog
from ..streaming import subscriber

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_LOG = """log AS (SELECT event_id, ts, user_id, value, props, 'p' || CAST(user_id % 8 AS VARCHAR) AS token,
  CASE WHEN event_type IN ('signup','click','purchase') THEN 'data' WHEN event_type = 'view' THEN 'heartbeat' ELSE 'child' END AS kind,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'UPDATE' WHEN 'purchase' THEN 'DELETE' END AS mod_type,
  row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) - 1 AS seq,
  NOT (event_type = 'purchase' AND value > 180) AS acked FROM events)"""
_META = (
    _LOG
    + """, spans AS (SELECT token, min(ts) AS start_timestamp, max(ts) AS last FROM log GROUP BY token),
meta AS (SELECT *, CASE WHEN state = 'CREATED' THEN start_timestamp ELSE last END AS watermark, CASE WHEN state = 'FINISHED' THEN last END AS finished_at FROM (
  SELECT token AS partition_token, start_timestamp, last, CASE WHEN token IN ('p0','p1') THEN 'FINISHED' WHEN token IN ('p2','p3') THEN 'RUNNING' WHEN token = 'p4' THEN 'SCHEDULED' ELSE 'CREATED' END AS state FROM spans))"""
)
START, END = datetime(2024, 1, 10), datetime(2024, 1, 12)


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.derived(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.derived_metadata(_log(spark, sf_dir))


def _shared(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _time(value: datetime):
    return F.lit(str(value)).cast("timestamp_ntz")


@query(f"""WITH {_LOG} SELECT event_id, token, kind, mod_type, ts FROM log WHERE token = 'p3' AND ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}'""")
def read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.read_partition(_log(spark, sf_dir), "p3", _time(START), _time(END)).select("event_id", "token", "kind", "mod_type", "ts")


@query(f"""WITH {_LOG} SELECT token, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket, kind, ts, event_id,
  row_number() OVER (PARTITION BY token ORDER BY date_trunc('hour', ts), CASE kind WHEN 'data' THEN 0 WHEN 'heartbeat' THEN 1 ELSE 2 END, ts, event_id) - 1 AS seq FROM log""")
def demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return changelog.numbered(_log(spark, sf_dir), ["token"], hour, ["ts", "event_id"]).select("token", hour.alias("bucket"), "kind", "ts", "event_id", "seq")


@query(f"""WITH {_LOG} SELECT token, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS bucket, kind, ts, event_id,
  row_number() OVER (PARTITION BY token ORDER BY date_trunc('minute', ts), CASE kind WHEN 'data' THEN 0 WHEN 'heartbeat' THEN 1 ELSE 2 END, ts, event_id) - 1 AS seq FROM log""")
def demux_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as they come on the wire, arrays of a minute's records each."""
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return changelog.demultiplexed(changelog.envelopes(_log(spark, sf_dir), ["token"], minute), ["token"])


@query(f"""WITH {_LOG}, gap AS (SELECT token, min(CASE WHEN kind = 'data' AND NOT acked THEN seq END) AS first_gap FROM log GROUP BY token)
SELECT l.token, g.first_gap, CAST(sum(CASE WHEN g.first_gap IS NULL OR l.seq < g.first_gap THEN 1 ELSE 0 END) AS BIGINT) AS n_acked,
  max_by(l.ts, CASE WHEN g.first_gap IS NULL OR l.seq < g.first_gap THEN l.seq END) AS watermark
FROM log l JOIN gap g ON l.token = g.token GROUP BY l.token, g.first_gap""")
def ack_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acks.ack_watermark(_log(spark, sf_dir), ["token"], ["ts", "event_id"])


@query(f"""WITH {_LOG}, numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM log),
gap AS (SELECT user_id, min(CASE WHEN kind = 'data' AND NOT acked THEN n END) AS first_gap FROM numbered GROUP BY user_id)
SELECT l.user_id, g.first_gap, CAST(sum(CASE WHEN g.first_gap IS NULL OR l.n < g.first_gap THEN 1 ELSE 0 END) AS BIGINT) AS n_acked,
  max_by(l.ts, CASE WHEN g.first_gap IS NULL OR l.n < g.first_gap THEN l.n END) AS watermark
FROM numbered l JOIN gap g ON l.user_id = g.user_id GROUP BY l.user_id, g.first_gap""")
def ack_watermark_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acks.ack_watermark(_log(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query(f"""WITH {_LOG}, gap AS (SELECT token, min(CASE WHEN kind = 'data' THEN seq END) AS first_gap FROM log GROUP BY token)
SELECT l.token, g.first_gap, CAST(sum(CASE WHEN g.first_gap IS NULL OR l.seq < g.first_gap THEN 1 ELSE 0 END) AS BIGINT) AS n_acked,
  max_by(l.ts, CASE WHEN g.first_gap IS NULL OR l.seq < g.first_gap THEN l.seq END) AS watermark
FROM log l JOIN gap g ON l.token = g.token GROUP BY l.token, g.first_gap""")
def heartbeat_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No data record is acknowledged: heartbeats and children count up to the first of them."""
    return acks.ack_watermark(_log(spark, sf_dir), ["token"], ["ts", "event_id"], acked=F.col("kind") != "data")


@query(f"""WITH {_LOG} SELECT event_id, token, seq FROM log""")
def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acks.sequenced(_log(spark, sf_dir), ["token"], ["ts", "event_id"], F.date_trunc("minute", "ts")).select("event_id", "token", "seq")


@query(f"""WITH {_LOG} SELECT event_id, token, seq FROM log WHERE seq < 5""")
def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = acks.admitted(_log(spark, sf_dir), ["token"], ["ts", "event_id"], 5).select("event_id", "token", "ts")
    return acks.sequenced(rows, ["token"], ["ts", "event_id"], F.lit(0)).select("event_id", "token", "seq")


@query(f"""WITH {_META} SELECT partition_token, state, watermark FROM meta WHERE state <> 'FINISHED' ORDER BY watermark, partition_token LIMIT 1""")
def min_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.min_watermark(_meta(spark, sf_dir)).select("partition_token", "state", "watermark")


@query(f"""WITH {_META} SELECT partition_token, state, watermark FROM meta WHERE state IN ('SCHEDULED','RUNNING') ORDER BY watermark, partition_token""")
def interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.interrupted(_meta(spark, sf_dir)).select("partition_token", "state", "watermark")


@query(f"""WITH {_META} SELECT partition_token, start_timestamp FROM meta WHERE state = 'CREATED' AND start_timestamp >= (SELECT min(watermark) FROM meta WHERE state <> 'FINISHED')""")
def schedulable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.schedulable(_meta(spark, sf_dir)).select("partition_token", "start_timestamp")


@query(f"""WITH {_META} SELECT partition_token FROM meta WHERE state IN ('SCHEDULED','RUNNING') AND partition_token <> 'p2'""")
def active_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = spark.range(1).select(F.lit("p2").alias("partition_token"))
    return partitions.to_start(partitions.interrupted(_meta(spark, sf_dir)), active).select("partition_token")


@query(f"""WITH {_META} SELECT count(*) FILTER (WHERE state <> 'FINISHED') AS n_open, min(watermark) FILTER (WHERE state <> 'FINISHED') AS low FROM meta""")
def termination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.unfinished(_meta(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_open"), F.min("watermark").alias("low"))


@query(f"""WITH {_LOG}, r AS (SELECT 'c' || CAST(user_id AS VARCHAR) AS token, 'p' || CAST(event_id % 8 AS VARCHAR) AS parent, ts AS start_timestamp, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM log WHERE kind = 'child')
SELECT token, parent, start_timestamp FROM r WHERE n = 1""")
def child_first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _log(spark, sf_dir).where("kind = 'child'").select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("token"), F.concat(F.lit("p"), (F.col("event_id") % 8).cast("string")).alias("parent"), F.col("ts").alias("start_timestamp"), "ts", "event_id")
    return partitions.first_children(found, ["ts", "event_id"])


@query(f"""WITH {_META} SELECT partition_token, CASE WHEN state = 'CREATED' THEN 'SCHEDULED' ELSE state END AS state, watermark, state = 'CREATED' AS stamped FROM meta""")
def state_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir).withColumn("scheduled_at", F.lit(None).cast("timestamp"))
    return partitions.transition(meta, F.col("state") == "CREATED", SCHEDULED, F.current_timestamp()).select("partition_token", "state", "watermark", F.col("scheduled_at").isNotNull().alias("stamped"))


@query(f"""WITH {_META} SELECT partition_token, CASE WHEN partition_token = 'p3' THEN TIMESTAMP '{START}' ELSE watermark END AS watermark FROM meta""")
def watermark_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.with_watermark(_meta(spark, sf_dir), "p3", _time(START)).select("partition_token", "watermark")


@query(f"""WITH {_META}, late AS (SELECT max(finished_at) + INTERVAL 1 DAY AS now FROM meta) SELECT partition_token, state FROM meta, late WHERE finished_at IS NULL OR finished_at >= now - INTERVAL 1 DAY""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir)
    late = meta.agg((F.max("finished_at") + F.expr("INTERVAL 1 DAY")).alias("now"))
    return partitions.retained(meta.join(F.broadcast(late)), F.col("now")).select("partition_token", "state")  # one row


@query(f"""WITH {_META} SELECT l.event_id, l.token FROM log l JOIN meta m ON m.partition_token = l.token WHERE l.ts >= m.watermark""")
def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acks.resumed(_log(spark, sf_dir), _meta(spark, sf_dir).withColumnRenamed("partition_token", "token"), ["token"]).select("event_id", "token")


@query(f"""WITH {_LOG}, d AS (SELECT event_id, '{{"Id":"' || CAST(event_id AS VARCHAR) || '","Big":"' || CAST(event_id * 3 AS VARCHAR) || '","Props":' || props || '}}' AS j FROM log)
SELECT event_id, CAST(json_extract_string(j, '$.Id') AS BIGINT) AS id, CAST(json_extract_string(j, '$.Big') AS BIGINT) AS big, CAST(json_extract_string(j, '$.Props.k') AS BIGINT) AS k FROM d""")
def decode_mods(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"Id":"'), F.col("event_id").cast("string"), F.lit('","Big":"'), (F.col("event_id") * 3).cast("string"), F.lit('","Props":'), F.col("props"), F.lit("}"))
    rows = _log(spark, sf_dir).select("event_id", text.alias("j")).withColumn("m", decode.values(F.col("j")))
    return rows.select("event_id", decode.typed(F.col("j"), "Id", "INT64").alias("id"), decode.typed(F.col("j"), "Big", "INT64").alias("big"), F.variant_get(F.try_element_at("m", F.lit("Props")), "$.k", "bigint").alias("k"))


@query("""SELECT o_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderstatus = 'F' THEN 'INSERT' ELSE 'UPDATE' END AS mod_type FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def mods_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys, new = F.to_json(F.struct(F.col("l_linenumber").cast("string").alias("l_linenumber"))), F.to_json(F.struct(F.col("l_partkey").cast("string").alias("l_partkey")))
    mods = lines.select("l_orderkey", F.struct(keys.alias("keys"), new.alias("new_values"), F.lit(None).cast("string").alias("old_values")).alias("m")).groupBy("l_orderkey").agg(F.collect_list("m").alias("mods"))
    records = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "INSERT").otherwise("UPDATE").alias("mod_type")).join(mods, F.col("o_orderkey") == F.col("l_orderkey"))
    rows = decode.modified_rows(records.select("o_orderkey", "mod_type", F.struct("mods").alias("record")), "record", [("l_linenumber", "INT64", None), ("l_partkey", "INT64", None)], ("l_linenumber",))
    return rows.select("o_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_partkey", "mod_type")


_LINE = """'{"commit_timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","record_sequence":"' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 8, '0') || '","server_transaction_id":"tx' || CAST(o_custkey AS VARCHAR)
  || '","is_last_record_in_transaction_in_partition":true,"table_name":"orders","column_types":' || CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE '[{"name":"o_orderkey","type":{"code":"INT64"},"is_primary_key":true,"ordinal_position":1},{"name":"tags","type":{"code":"ARRAY","array_element_type":{"code":"STRING"}},"ordinal_position":2}]' END
  || ',"mods":' || CASE WHEN o_orderkey % 5 = 0 THEN '[]' ELSE '[{"keys":{"o_orderkey":"' || CAST(o_orderkey AS VARCHAR) || '"}' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE ',"new_values":{"tags":["' || o_orderpriority || '"]}' END || '}]' END
  || ',"mod_type":"' || CASE WHEN o_orderstatus = 'F' THEN 'DELETE' ELSE 'INSERT' END || '","value_capture_type":"NEW_VALUES","number_of_records_in_transaction":1,"number_of_partitions_in_transaction":1,"transaction_tag":"","is_system_transaction":false}'"""


@query(f"""SELECT o_orderkey, {_LINE} AS line FROM orders""")
def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with one data change each, some without column types or mods, as JSON lines."""
    gone, key = F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")
    types = F.from_json(F.lit('[{"name":"o_orderkey","type":{"code":"INT64"},"is_primary_key":true,"ordinal_position":1},{"name":"tags","type":{"code":"ARRAY","array_element_type":{"code":"STRING"}},"is_primary_key":false,"ordinal_position":2}]'), f"array<{COLUMN_TYPE}>")
    mod = F.struct(F.concat(F.lit('{"o_orderkey":"'), key, F.lit('"}')).alias("keys"), F.when(gone, "{}").otherwise(F.concat(F.lit('{"tags":["'), F.col("o_orderpriority"), F.lit('"]}'))).alias("new_values"), F.when(gone, F.lit(None)).otherwise("{}").alias("old_values"))
    fields = {
        "commit_timestamp": F.col("o_orderdate").cast("timestamp"), "record_sequence": F.lpad((F.col("o_orderkey") % 100).cast("string"), 8, "0"), "server_transaction_id": F.concat(F.lit("tx"), F.col("o_custkey").cast("string")),
        "is_last_record_in_transaction_in_partition": F.lit(True), "table_name": F.lit("orders"), "column_types": F.when(F.col("o_orderkey") % 3 != 0, types), "mods": F.when(F.col("o_orderkey") % 5 != 0, F.array(mod)),
        "mod_type": F.when(gone, "DELETE").otherwise("INSERT"), "value_capture_type": F.lit("NEW_VALUES"), "number_of_records_in_transaction": F.lit(1).cast("long"), "number_of_partitions_in_transaction": F.lit(1).cast("long"),
        "transaction_tag": F.lit(""), "is_system_transaction": F.lit(False),
    }
    record = F.struct(*(c.alias(n) for n, c in fields.items())).cast(DATA_CHANGE)
    envelope = F.struct(F.array(record).alias("data_change_record"))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", envelope.alias("envelope"))
    return decode.data_changes(rows, "envelope").select("o_orderkey", decode.change_line(F.col("record")).alias("line"))


@query(f"""WITH {_LOG} SELECT event_id, '{{"commit_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","token":"' || token || '","kind":"' || kind || '"' || CASE WHEN mod_type IS NULL THEN '' ELSE ',"mod_type":"' || mod_type || '"' END || '}}' AS line FROM log""")
def ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("event_id", decode.json_line([F.col("ts").alias("commit_timestamp"), F.col("token"), F.col("kind"), F.col("mod_type")]).alias("line"))


@query(f"""WITH {_LOG} SELECT event_id, ['{"','".join(TYPE_CODES)}'][CAST(event_id % {len(TYPE_CODES)} AS INTEGER) + 1] AS code, CASE WHEN event_id % {len(TYPE_CODES)} = {TYPE_CODES.index("ARRAY")} THEN 'INT64' END AS element, CASE WHEN event_id % {len(TYPE_CODES)} = {TYPE_CODES.index("PROTO")} THEN 'a.B' END AS fqn FROM log""")
def decode_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, TYPE_CODES)), (F.col("event_id") % len(TYPE_CODES) + 1).cast("int"))
    extra = F.when(code == "ARRAY", F.lit(',"array_element_type":{"code":"INT64"}')).when(code == "PROTO", F.lit(',"proto_type_fqn":"a.B"')).otherwise("")
    rows = _log(spark, sf_dir).select("event_id", F.concat(F.lit('{"code":"'), code, F.lit('"'), extra, F.lit("}")).alias("j"))
    t = decode.column_type(F.col("j"))
    return rows.select("event_id", t["code"].alias("code"), t["array_element_type"]["code"].alias("element"), t["proto_type_fqn"].alias("fqn"))


_ODD_TYPES = ("null", "3", "[]", '"x"', "no json", "{}", '{"code":1}', '{"code":"ARRAY","array_element_type":{}}', '{"code":"UUID"}', '{"code":"ARRAY","array_element_type":{"code":"PROTO","proto_type_fqn":"a.B"}}')


@query(f"""WITH {_LOG}, d AS (SELECT event_id, CAST(event_id % {len(_ODD_TYPES) + 1} AS INTEGER) AS k FROM log)
SELECT event_id, CASE WHEN k < 5 OR k = {len(_ODD_TYPES)} THEN '' WHEN k IN (5, 6) THEN NULL WHEN k = 8 THEN 'UUID' ELSE 'ARRAY' END AS code, CASE WHEN k = 9 THEN 'PROTO' END AS element, CASE WHEN k = 9 THEN 'a.B' END AS fqn FROM d""")
def decode_types_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types that are null, no objects, or objects without a code, read without failing."""
    k = (F.col("event_id") % (len(_ODD_TYPES) + 1)).cast("int")
    rows = _log(spark, sf_dir).select("event_id", F.get(F.array(*map(F.lit, _ODD_TYPES)), k).alias("j"))
    t = decode.column_type(F.col("j"), strict=False)
    return rows.select("event_id", t["code"].alias("code"), t["array_element_type"]["code"].alias("element"), t["array_element_type"]["proto_type_fqn"].alias("fqn"))


def _moved(spark: SparkSession, sf_dir: str, state: str, stamp: str) -> DataFrame:
    meta = _meta(spark, sf_dir).withColumns({c: F.lit(None).cast("timestamp") for c in ("running_at", "finished_at")})
    return partitions.transition(meta, F.col("partition_token") == "p4", state, F.current_timestamp()).select("partition_token", "state", "watermark", F.col(stamp).isNotNull().alias("stamped"))


_MOVED = "SELECT partition_token, CASE WHEN partition_token = 'p4' THEN '{0}' ELSE state END AS state, watermark, partition_token = 'p4' AS stamped FROM meta"


@query(f"WITH {_META} {_MOVED.format('RUNNING')}")
def state_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved(spark, sf_dir, RUNNING, "running_at")


@query(f"WITH {_META} {_MOVED.format('FINISHED')}")
def state_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark stays as it was."""
    return _moved(spark, sf_dir, FINISHED, "finished_at")


@query(f"""WITH {_LOG} SELECT event_id, token, ts FROM log WHERE kind = 'data' AND ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}'""")
def bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a subscription with a start and an end bound gives its consumer, over the derived log as files; it ends by itself."""
    folder = _shared(spark)
    log = _log(spark, sf_dir)
    record = F.when(F.col("kind") == "child", F.lit('{"child_partitions":[]}')).otherwise(F.to_json(F.struct("event_id")))
    changelog.write_log(log.select("token", "kind", "ts", "event_id", record.alias("record")), f"{folder}/log", ["ts", "event_id"])
    found = log.select("token").distinct().agg(F.array_sort(F.collect_list(F.struct("token", F.array(F.lit("Parent0")).alias("parent_partition_tokens")))).alias("child_partitions"))
    root = found.select(F.lit("Parent0").alias("token"), F.lit("child").alias("kind"), _time(START).alias("ts"), F.to_json(F.struct("child_partitions")).alias("record"))
    changelog.write_log(root, f"{folder}/log", ["ts"])
    utc = timezone.utc
    parsed = F.from_json("record", "event_id bigint")["event_id"]

    def keep(rows: DataFrame) -> None:
        rows.select(parsed.alias("event_id"), "token", F.expr("timestamp_micros(unix_micros(ts))").alias("at")).write.mode("append").parquet(f"{folder}/out")

    subscriber.Subscriber(
        subscriber.Config(spark=spark, stream_name="derived", partition_storage=store.MemoryStore(), batch_consumer=keep, path=f"{folder}/log", work=f"{folder}/work", start=START.replace(tzinfo=utc), end=END.replace(tzinfo=utc), partition_discovery_interval=0.2)
    ).subscribe()
    return spark.read.schema("event_id bigint, token string, at timestamp").parquet(f"{folder}/out").select("event_id", "token", F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"))


@query("""SELECT attempt, least(100 * power(2, attempt - 1), 5000) AS wait_ms FROM (SELECT CAST(range AS BIGINT) + 1 AS attempt FROM range(7))""")
def backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1, 8).select(F.col("id").alias("attempt"), retry.backoff_ms(F.col("id"), 100, 5000, 2).alias("wait_ms"))


@query("""SELECT closed, failed, shut, cancelled, CASE WHEN closed THEN 'closed' WHEN failed THEN 'error' WHEN shut THEN 'shutdown' WHEN cancelled THEN 'cancelled' ELSE 'none' END AS result
FROM (SELECT n % 2 = 1 AS closed, n // 2 % 2 = 1 AS failed, n // 4 % 2 = 1 AS shut, n // 8 % 2 = 1 AS cancelled FROM (SELECT range AS n FROM range(16)))""")
def exit_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {type(None): "none", subscriber.Closed: "closed", ValueError: "error", subscriber.Shutdown: "shutdown", subscriber.Cancelled: "cancelled"}
    rows = []
    for n in range(16):
        closed, failed, shut, cancelled = (n >> k & 1 == 1 for k in range(4))
        rows.append((closed, failed, shut, cancelled, names[type(subscriber.exit_error(closed, ValueError() if failed else None, shut, cancelled))]))
    return spark.createDataFrame(rows, "closed boolean, failed boolean, shut boolean, cancelled boolean, result string")


@query("""SELECT 'Parent0' AS partition_token, 0 AS n_parents, TIMESTAMP '2024-01-01 00:00:00' AS start_timestamp, TIMESTAMP '2024-01-01 01:00:00' AS end_timestamp, CAST(10000 AS BIGINT) AS heartbeat_millis, 'CREATED' AS state, TIMESTAMP '2024-01-01 00:00:00' AS watermark""")
def init_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = partitions.root(spark, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"), 10_000, F.current_timestamp())
    return row.select("partition_token", F.size("parent_tokens").alias("n_parents"), "start_timestamp", "end_timestamp", "heartbeat_millis", "state", "watermark")


@query("""SELECT token, nullif(token, 'Parent0') AS asked, token = 'Parent0' AS is_root FROM (VALUES ('Parent0'), ('p1'), ('')) v(token)""")
def root_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.range(1).select(F.explode(F.array(F.lit("Parent0"), F.lit("p1"), F.lit(""))).alias("token"))
    return rows.select("token", partitions.root_token(F.col("token")).alias("asked"), partitions.is_root(F.col("token")).alias("is_root"))


_CODES = ("OK", "Canceled", "InvalidArgument", "NotFound", "AlreadyExists", "PermissionDenied", "Aborted", "Unavailable", "DeadlineExceeded", "ResourceExhausted", "Internal")


@query(f"""SELECT code, code IN ('Unavailable', 'DeadlineExceeded', 'ResourceExhausted', 'Internal') AS retryable FROM (VALUES {", ".join(f"('{c}')" for c in _CODES)}) v(code)""")
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.range(1).select(F.explode(F.array(*map(F.lit, _CODES))).alias("code"))
    return rows.select("code", F.col("code").isin(*retry.RETRYABLE).alias("retryable"))


@query("""SELECT name, coalesce(nullif(given, 0), standard) AS used FROM (VALUES ('heartbeat_ms', 0, 10000), ('max_inflight', 7, 1), ('discovery_ms', 0, 1000)) v(name, given, standard)""")
def config_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = subscriber.validated(subscriber.Config(spark=spark, stream_name="s", partition_storage=store.MemoryStore(), consumer=print, max_inflight=7))
    rows = [("heartbeat_ms", round(used.heartbeat_interval * 1000)), ("max_inflight", used.max_inflight), ("discovery_ms", round(used.partition_discovery_interval * 1000))]
    return spark.createDataFrame(rows, "name string, used int")


#: The query that a smoke check runs.
FLAGSHIP = ack_watermark
