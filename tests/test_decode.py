import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions import decode, schemas


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "j string").select(f(F.col("j")).alias("x")).first().x


@pytest.mark.parametrize("code", [c for c in schemas.TYPE_CODES if c != "ARRAY"])
def test_scalar_types(spark, code):
    got = one(spark, json.dumps({"code": code}), decode.column_type)
    assert (got.code, got.array_element_type, got.proto_type_fqn) == (code, None, None)


def test_array_and_named_types(spark):
    got = one(spark, '{"code":"ARRAY","array_element_type":{"code":"PROTO","proto_type_fqn":"a.B"}}', decode.column_type)
    assert (got.code, got.array_element_type.code, got.array_element_type.proto_type_fqn) == ("ARRAY", "PROTO", "a.B")
    assert one(spark, '{"code":"ENUM","proto_type_fqn":"a.E"}', decode.column_type).proto_type_fqn == "a.E"


@pytest.mark.parametrize("text", [None, "null", "3", "[]", '"x"', "no json"])
def test_no_type(spark, text):
    assert one(spark, text, decode.column_type).code == ""


@pytest.mark.parametrize("text", ["{}", '{"code":1}', '{"code":"ARRAY","array_element_type":{}}'])
def test_broken_type_is_an_error(spark, text):
    with pytest.raises(Exception, match="type without a code"):
        one(spark, text, decode.column_type)
    one(spark, text, lambda j: decode.column_type(j, strict=False))


def test_values(spark):
    rows = spark.createDataFrame([(None,), ("{}",), ('{"a":1,"b":null}',)], "j string").select(decode.values(F.col("j")).alias("m"))
    assert [None if r.n is None else r.n for r in rows.select(F.when(F.col("m").isNotNull(), F.size("m")).alias("n")).collect()] == [None, 0, 2]
    with pytest.raises(Exception, match="not an object"):
        one(spark, "[1]", lambda j: F.size(decode.values(j)))


def test_typed_values(spark):
    text = json.dumps({
        "open": True, "stock": "9007199254740993", "share": 1.75, "load": -12.5, "since": "2021-07-04T05:06:07Z", "day": "2020-02-29", "town": "Ærø", "seal": "AP8Q", "price": "80.05",
        "more": '{"size":[3,4]}', "steps": ["-4", "17"], "keys": ["/w==", ""], "rates": ["0.001", "2.5"], "blob": "CgE=", "level": "6", "ident": "9b2f", "gap": None,
    })
    columns = [(c, k, None) for c, k in (("open", "BOOL"), ("stock", "INT64"), ("share", "FLOAT32"), ("load", "FLOAT64"), ("since", "TIMESTAMP"), ("day", "DATE"), ("town", "STRING"), ("seal", "BYTES"), ("price", "NUMERIC"), ("blob", "PROTO"), ("level", "ENUM"), ("ident", "UUID"), ("gap", "INT64"), ("missing", "INT64"))]
    columns += [("steps", "ARRAY", "INT64"), ("keys", "ARRAY", "BYTES"), ("rates", "ARRAY", "NUMERIC")]
    r = decode.project(spark.createDataFrame([(text,)], "j string"), "j", columns).select("*", F.variant_get(decode.typed(F.col("j"), "more", "JSON"), "$.size[1]", "int").alias("size")).first()
    assert (r.open, r.stock, r.share, r.load, r.town, bytes(r.seal), str(r.price), r.size) == (True, 9007199254740993, 1.75, -12.5, "Ærø", b"\x00\xff\x10", "80.050000000", 4)
    assert (r.since.isoformat(), str(r.day), bytes(r.blob), r.level, r.ident, r.gap, r.missing) == ("2021-07-04T05:06:07", "2020-02-29", b"\n\x01", 6, "9b2f", None, None)
    assert (r.steps, [bytes(b) for b in r["keys"]], [str(n) for n in r.rates]) == ([-4, 17], [b"\xff", b""], ["0.001000000", "2.500000000"])


def test_change_line_leaves_empty_parts_out(spark):
    at = datetime(2022, 3, 4, 5, 6, 7, 89, tzinfo=timezone.utc)
    types = [("berth", ("INT64", None, None), True, 1), ("flags", ("ARRAY", ("BOOL", None), None), False, 2)]
    record = (at, "00000042", "move-7", False, "Ships", types, [('{"berth":"12"}', "{}", '{"flags":[true,false]}')], "DELETE", "OLD_VALUES", 3, 2, "", True)
    line = spark.createDataFrame([(record,)], f"r {schemas.DATA_CHANGE}").select(decode.change_line(F.col("r")).alias("x")).first().x
    got = json.loads(line)
    assert got["commit_timestamp"] == "2022-03-04T05:06:07.000089Z"
    assert got["mods"] == [{"keys": {"berth": "12"}, "old_values": {"flags": [True, False]}}]
    assert got["column_types"] == [{"name": "berth", "type": {"code": "INT64"}, "is_primary_key": True, "ordinal_position": 1}, {"name": "flags", "type": {"code": "ARRAY", "array_element_type": {"code": "BOOL"}}, "ordinal_position": 2}]


def test_arrays_are_never_null(spark):
    rows = spark.createDataFrame([((None,) * 13,)], f"r {schemas.DATA_CHANGE}").select(decode.complete(F.col("r")).alias("r"))
    r = rows.first().r
    assert (r.column_types, r.mods) == ([], [])
