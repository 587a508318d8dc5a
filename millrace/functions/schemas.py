"""Schemas of change records and partition metadata.

Times are microseconds; finer ones are cut on ingest, so the open end bound is 9999-12-31T23:59:59.999999Z.
Row values stay JSON text until a caller asks for types.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Column type codes.
TYPE_CODES = ("BOOL", "INT64", "FLOAT64", "TIMESTAMP", "DATE", "STRING", "BYTES", "NUMERIC", "JSON", "ARRAY", "FLOAT32", "PROTO", "ENUM", "UUID")
#: Kinds of row modification.
MOD_TYPES = ("INSERT", "UPDATE", "DELETE")
#: A partition's states, in their order.
CREATED, SCHEDULED, RUNNING, FINISHED = "CREATED", "SCHEDULED", "RUNNING", "FINISHED"
#: Fixed value: the token under which the first partition is kept; the stream itself is asked for a null token then.
ROOT_TOKEN = "Parent0"
#: Fixed value: the end bound of a subscription without one.
OPEN_END = "9999-12-31 23:59:59.999999"

ELEMENT = "struct<code:string,proto_type_fqn:string>"
TYPE = f"struct<code:string,array_element_type:{ELEMENT},proto_type_fqn:string>"
COLUMN_TYPE = f"struct<name:string,type:{TYPE},is_primary_key:boolean,ordinal_position:bigint>"
MOD = "struct<keys:string,new_values:string,old_values:string>"

DATA_CHANGE = (
    "struct<commit_timestamp:timestamp,record_sequence:string,server_transaction_id:string,is_last_record_in_transaction_in_partition:boolean,table_name:string,"
    f"column_types:array<{COLUMN_TYPE}>,mods:array<{MOD}>,mod_type:string,value_capture_type:string,number_of_records_in_transaction:bigint,"
    "number_of_partitions_in_transaction:bigint,transaction_tag:string,is_system_transaction:boolean>"
)
HEARTBEAT = "struct<timestamp:timestamp>"
CHILDREN = "struct<start_timestamp:timestamp,record_sequence:string,child_partitions:array<struct<token:string,parent_partition_tokens:array<string>>>>"
ENVELOPE = f"struct<data_change_record:array<{DATA_CHANGE}>,heartbeat_record:array<{HEARTBEAT}>,child_partitions_record:array<{CHILDREN}>>"

_TIME = T.TimestampType()
METADATA = T.StructType(
    [
        T.StructField("partition_token", T.StringType(), False),
        T.StructField("parent_tokens", T.ArrayType(T.StringType()), False),
        T.StructField("start_timestamp", _TIME, False),
        T.StructField("end_timestamp", _TIME, False),
        T.StructField("heartbeat_millis", T.LongType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("watermark", _TIME, False),
        T.StructField("created_at", _TIME, False),
        T.StructField("scheduled_at", _TIME),
        T.StructField("running_at", _TIME),
        T.StructField("finished_at", _TIME),
    ]
)
