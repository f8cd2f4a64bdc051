"""Tables declared by a record file: an Avro schema (``.avsc``) as the contract of a layer.

The file is JSON on shared storage.  It becomes a Spark schema, an existing table is
checked against it, and arriving rows are matched to it by name.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

PRIMITIVES: dict[str, DataType] = {
    "boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(), "double": DoubleType(),
    "bytes": BinaryType(), "string": StringType(),
}
LOGICAL: dict[tuple[str, str], DataType] = {
    ("int", "date"): DateType(),
    ("long", "timestamp-millis"): TimestampType(),
    ("long", "timestamp-micros"): TimestampType(),
    ("long", "local-timestamp-millis"): TimestampNTZType(),
    ("long", "local-timestamp-micros"): TimestampNTZType(),
    ("string", "uuid"): StringType(),
}
_DEFAULT = "default"  # metadata key: the default as JSON, as the file has it


class RecordError(ValueError):
    """A record file that cannot be read, or a table that does not fit it."""


def _type_of(spec: Any, named: dict[str, DataType | None], space: str) -> tuple[DataType, bool]:
    """Spark type of one Avro type, and whether it may be null.  ``named``: types met so far."""
    if isinstance(spec, list):
        rest = [s for s in spec if s != "null"]
        if len(rest) != 1:
            raise RecordError(f"a union of one type and null is expected, not {json.dumps(spec)}")
        return _type_of(rest[0], named, space)[0], len(rest) < len(spec)
    if isinstance(spec, str):
        if spec in PRIMITIVES:
            return PRIMITIVES[spec], False
        full = spec if "." in spec or not space else f"{space}.{spec}"
        if named.get(full) is None:
            raise RecordError(f"{spec} is recursive" if full in named else f"unknown type {spec}")
        return named[full], False
    if not isinstance(spec, dict) or "type" not in spec:
        raise RecordError(f"not a type: {json.dumps(spec)}")
    kind, logical = spec["type"], spec.get("logicalType")
    if isinstance(kind, (dict, list)):
        return _type_of(kind, named, space)
    if logical == "decimal" and kind in ("bytes", "fixed"):
        found: DataType = DecimalType(spec["precision"], spec.get("scale", 0))
    elif (kind, logical) in LOGICAL:
        found = LOGICAL[kind, logical]
    elif kind == "array":
        item, holes = _type_of(spec["items"], named, space)
        found = ArrayType(item, holes)
    elif kind == "map":
        item, holes = _type_of(spec["values"], named, space)
        found = MapType(StringType(), item, holes)
    elif kind == "enum":
        found = StringType()
    elif kind == "fixed":
        found = BinaryType()
    elif kind == "record":
        own_space = spec.get("namespace", space)
        name = spec["name"] if "." in spec["name"] or not own_space else f"{own_space}.{spec['name']}"
        named[name] = None
        found = _struct(spec, named, name.rpartition(".")[0])
    else:
        return _type_of(kind, named, space)
    if kind in ("record", "enum", "fixed"):
        own_space = spec.get("namespace", space)
        named[spec["name"] if "." in spec["name"] or not own_space else f"{own_space}.{spec['name']}"] = found
    return found, False


def _struct(spec: dict, named: dict[str, DataType | None], space: str) -> StructType:
    fields, seen = [], set()
    for f in spec.get("fields", []):
        if not isinstance(f, dict) or "name" not in f or "type" not in f:
            raise RecordError(f"not a field: {json.dumps(f)}")
        if f["name"].lower() in seen:
            raise RecordError(f"the field {f['name']} stands twice")
        seen.add(f["name"].lower())
        kind, nullable = _type_of(f["type"], named, space)
        about = {"comment": f["doc"]} if f.get("doc") else {}
        if "default" in f:
            # The default of a union belongs to its first type.
            first = f["type"][0] if isinstance(f["type"], list) and f["type"] else f["type"]
            if f["default"] is None and first != "null":
                raise RecordError(f"null is no default of {f['name']}, whose type is {json.dumps(f['type'])}")
            about[_DEFAULT] = json.dumps(f["default"])
        fields.append(StructField(f["name"], kind, nullable, about))
    return StructType(fields)


def parse_record(text: str) -> StructType:
    """The fields of an Avro record, in their order; nullable where null is in the union.

    Defaults stand in the metadata of the fields, as JSON; ``doc`` becomes the comment.
    """
    try:
        spec = json.loads(text)
    except ValueError as e:
        raise RecordError(f"not JSON: {e}") from e
    if not isinstance(spec, dict) or spec.get("type") != "record" or not spec.get("fields"):
        raise RecordError("a record with fields is expected")
    return _type_of(spec, {}, "")[0]


def read_record(spark: SparkSession, path: str) -> StructType:
    """The record of a file on any storage that Spark reads."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise RecordError(f"one file is expected at {path}")
    return parse_record(rows[0][0])


def render_record(schema: StructType, name: str) -> str:
    """The Avro record of a flat schema; every nullable field may be null and is so by default."""
    simple = {kind: avro for avro, kind in PRIMITIVES.items()}
    fields = []
    for f in schema.fields:
        if f.dataType not in simple:
            raise RecordError(f"no plain Avro type for {f.name}: {f.dataType.simpleString()}")
        avro = simple[f.dataType]
        fields.append({"name": f.name, "type": ["null", avro], "default": None} if f.nullable else {"name": f.name, "type": avro})
    return json.dumps({"type": "record", "name": name, "fields": fields}, indent=2)


def write_record(spark: SparkSession, text: str, folder: str) -> None:
    """A record file below ``folder``, on any storage that Spark writes."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(folder)


def differences(found: StructType, record: StructType, keys: list[str]) -> list[str]:
    """What keeps a table from having the record's fields, then the partition columns."""
    want = [*record.fields, *[StructField(k, StringType()) for k in keys]]
    have = {f.name: f for f in found.fields}
    out = [f"{f.name} is missing" for f in want if f.name not in have]
    out += [f"{f.name} is not in the record" for f in found.fields if f.name not in {w.name for w in want}]
    out += [
        f"{f.name} is {have[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
        for f in want
        if f.name in have and have[f.name].dataType != f.dataType
    ]
    if not out:
        moved = [f.name for f, h in zip(want, found.fields) if f.name != h.name]
        if moved:
            out.append(f"order differs from {moved[0]} on")
    return out


def require_record(schema: StructType, record: StructType, keys: list[str], what: str) -> None:
    """An error unless a table has exactly the record's fields, in its order, then ``keys``.

    Writers that insert by place would fill the wrong columns of any other table.
    """
    wrong = differences(schema, record, keys)
    if wrong:
        raise RecordError(f"{what} does not fit its record: {'; '.join(wrong)}")


def resolve_record(df: DataFrame, record: StructType, keys: list[str]) -> DataFrame:
    """Rows matched to the record by name, as Avro readers match them.

    Order does not matter, columns the record does not have are left out, and a
    missing one takes its default; without a default, or with another type, it is an
    error.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong, out = [], []
    for f in [*record.fields, *[StructField(k, StringType()) for k in keys]]:
        if f.name in have:
            if have[f.name] != f.dataType:
                wrong.append(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
            out.append(F.col(f"`{f.name}`"))
        elif _DEFAULT in f.metadata:
            value = json.loads(f.metadata[_DEFAULT])
            if isinstance(value, (list, dict)):
                given = F.from_json(F.lit(f.metadata[_DEFAULT]), f.dataType)
            else:
                given = F.lit(value).cast(f.dataType)
            out.append(given.alias(f.name))
        else:
            wrong.append(f"{f.name} is missing and has no default")
    if wrong:
        raise RecordError(f"rows do not fit their record: {'; '.join(wrong)}")
    return df.select(*out)
