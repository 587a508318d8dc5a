"""Decoding of change records: column types, row values, typed projections, and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schemas

#: Spark type that a scalar code's JSON form is read as; BYTES and PROTO are base64 text, JSON is text that holds JSON.
SCALARS = {
    "BOOL": "boolean", "INT64": "bigint", "FLOAT64": "double", "TIMESTAMP": "timestamp", "DATE": "date", "STRING": "string", "BYTES": "string",
    "NUMERIC": "decimal(38,9)", "JSON": "string", "FLOAT32": "float", "PROTO": "string", "ENUM": "bigint", "UUID": "string",
}


def column_type(json: Column, strict: bool = True) -> Column:
    """A column's type from its JSON. Null or anything but an object is the empty code; an object without a text code is an error (null if not ``strict``)."""
    raw = F.try_parse_json(json)
    shape = F.schema_of_variant(raw)
    read = F.from_json(json, schemas.TYPE)
    is_object = F.coalesce(shape.startswith("OBJECT"), F.lit(False))

    def text(path: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.variant_get(raw, path, "variant")) == "STRING", F.lit(False))

    def part(path: str, value: Column) -> Column:
        bad = F.raise_error(F.concat(F.lit("type without a code: "), json)).cast("string") if strict else F.lit(None).cast("string")
        return F.when(text(path), value).otherwise(bad)

    has_element = F.coalesce(F.schema_of_variant(F.variant_get(raw, "$.array_element_type", "variant")).startswith("OBJECT"), F.lit(False))
    element = F.when(has_element, F.struct(part("$.array_element_type.code", read["array_element_type"]["code"]).alias("code"), read["array_element_type"]["proto_type_fqn"].alias("proto_type_fqn")))
    full = F.struct(part("$.code", read["code"]).alias("code"), element.alias("array_element_type"), read["proto_type_fqn"].alias("proto_type_fqn"))
    none = F.struct(F.lit("").alias("code"), F.lit(None).cast(schemas.ELEMENT).alias("array_element_type"), F.lit(None).cast("string").alias("proto_type_fqn"))
    return F.when(is_object, full).otherwise(none)


def values(json: Column, strict: bool = True) -> Column:
    """A row's values by column name, undecoded. Null stays null, ``{}`` is an empty map, anything but an object is an error (null if not ``strict``)."""
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json(json)).startswith("OBJECT"), F.lit(False))
    bad = F.raise_error(F.concat(F.lit("not an object: "), json)).cast("map<string,variant>") if strict else F.lit(None).cast("map<string,variant>")
    return F.when(json.isNull(), F.lit(None).cast("map<string,variant>")).when(ok, F.from_json(json, "map<string,variant>")).otherwise(bad)


def typed(json: Column, name: str, code: str, element: str | None = None) -> Column:
    """One column of a row's JSON as a Spark value. A missing column and a JSON null are both null."""
    raw, path = F.parse_json(json), f"$['{name}']"
    if code == "ARRAY":
        kind = SCALARS[element or "STRING"]
        out = F.try_variant_get(raw, path, f"array<{kind}>")
        if element in ("BYTES", "PROTO"):
            return F.transform(out, F.unbase64)
        return F.transform(out, F.parse_json) if element == "JSON" else out
    out = F.try_variant_get(raw, path, SCALARS[code])
    if code in ("BYTES", "PROTO"):
        return F.unbase64(out)
    return F.parse_json(out) if code == "JSON" else out


def project(rows: DataFrame, json_col: str, columns: list[tuple[str, str, str | None]]) -> DataFrame:
    """``rows`` with a typed column for each (name, code, element code) of a target table."""
    return rows.select("*", *(typed(F.col(json_col), n, c, e).alias(n) for n, c, e in columns))


def complete(record: Column) -> Column:
    """A data change with arrays that are never null."""
    for name in ("column_types", "mods"):
        record = record.withField(name, F.coalesce(record[name], F.array().cast(f"array<{schemas.COLUMN_TYPE if name == 'column_types' else schemas.MOD}>")))
    return record


def data_changes(rows: DataFrame, envelope_col: str, name: str = "record") -> DataFrame:
    """A row for each data change of the envelopes, complete, with the other columns."""
    found = rows.select(*(c for c in rows.columns if c != envelope_col), F.explode(F.col(envelope_col)["data_change_record"]).alias(name))
    return found.withColumn(name, complete(F.col(name)))


def modified_rows(rows: DataFrame, record_col: str, columns: list[tuple[str, str, str | None]], keys: tuple[str, ...]) -> DataFrame:
    """A row for each modified row of data changes, with typed columns (name, code, element code): the keys from the mod's keys, the others from its new values."""
    mods = rows.select("*", F.explode(F.col(record_col)["mods"]).alias("_mod"))
    out = [typed(F.col("_mod")["keys" if n in keys else "new_values"], n, c, e).alias(n) for n, c, e in columns]
    return mods.select(*rows.columns, *out).drop(record_col)


#: Times in JSON lines: always six digits.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def json_line(columns: list[Column]) -> Column:
    """One JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns), {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def omit_empty(values_: Column) -> Column:
    """A map that is left out of JSON lines when it is empty."""
    return F.when(F.size(values_) > 0, values_)


def change_line(record: Column) -> Column:
    """A data change as a JSON line. Row values are nested objects; empty ones, false keys and missing type parts are left out."""

    def row(json: Column) -> Column:
        return omit_empty(F.from_json(json, "map<string,variant>"))

    mods = F.transform(record["mods"], lambda m: F.struct(row(m["keys"]).alias("keys"), row(m["new_values"]).alias("new_values"), row(m["old_values"]).alias("old_values")))
    types = F.transform(record["column_types"], lambda c: c.withField("is_primary_key", F.when(c["is_primary_key"], F.lit(True))))
    return F.to_json(record.withField("column_types", types).withField("mods", mods), {"timestampFormat": TIME_FORMAT})
