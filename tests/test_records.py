"""Record files: parsing, checking tables, matching rows, and landing by them."""

import json
import uuid

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from claimflow.fixed_values import LANDING_PARTITION
from claimflow.plans import layers
from claimflow.sources import catalogue, records, schemas


def record(*fields, **more):
    return json.dumps({"type": "record", "name": "R", "fields": list(fields), **more})


TEXT = {"name": "a", "type": ["null", "string"], "default": None}


def test_types():
    parsed = records.parse_record(
        record(
            TEXT,
            {"name": "b", "type": "long", "doc": "how many"},
            {"name": "c", "type": [{"type": "int", "logicalType": "date"}, "null"], "default": 0},
            {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
            {"name": "e", "type": {"type": "array", "items": ["null", "double"]}},
            {"name": "f", "type": {"type": "map", "values": "boolean"}},
            {"name": "g", "type": {"type": "record", "name": "In", "fields": [{"name": "x", "type": "float"}]}},
            {"name": "h", "type": ["null", "In"]},
            {"name": "i", "type": {"type": "enum", "name": "E", "symbols": ["A"]}},
            {"name": "j", "type": {"type": "fixed", "name": "F", "size": 4}},
            {"name": "k", "type": {"type": "long", "logicalType": "timestamp-micros"}},
            {"name": "l", "type": {"type": "string"}},
            {"name": "m", "type": "n.s.E2"},
            namespace="n.s",
        ).replace('"n.s.E2"', '{"type": "enum", "name": "E2", "symbols": []}')
    )
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in parsed.fields] == [
        ("a", "string", True), ("b", "bigint", False), ("c", "date", True), ("d", "decimal(9,2)", False),
        ("e", "array<double>", False), ("f", "map<string,boolean>", False), ("g", "struct<x:float>", False),
        ("h", "struct<x:float>", True), ("i", "string", False), ("j", "binary", False), ("k", "timestamp", False),
        ("l", "string", False), ("m", "string", False),
    ]
    assert parsed["b"].metadata == {"comment": "how many"} and parsed["c"].metadata == {"default": "0"}


@pytest.mark.parametrize(
    "text",
    [
        "{", "[]", '{"type": "enum"}', record(), record({"name": "a"}), record({"name": "a", "type": "no_such"}),
        record({"name": "a", "type": ["int", "string"]}), record({"name": "a", "type": ["null"]}), record(TEXT, {**TEXT, "name": "A"}),
        record({"name": "a", "type": "string", "default": None}), record({"name": "a", "type": 5}),
        record({"name": "a", "type": ["null", "R"]}),
    ],
)
def test_bad_files(text):
    with pytest.raises(records.RecordError):
        records.parse_record(text)


def test_file_round_trip(spark, tmp_path):
    schema = StructType([StructField("a", StringType()), StructField("n", schemas.IntegerType(), False)])
    path = str(tmp_path / "record")
    records.write_record(spark, records.render_record(schema, "T"), path)
    read = records.read_record(spark, path)
    assert [(f.name, f.dataType, f.nullable) for f in read.fields] == [(f.name, f.dataType, f.nullable) for f in schema.fields]
    with pytest.raises(records.RecordError):
        records.render_record(StructType().add("x", schemas.StructType()), "T")


def test_tables_have_to_fit():
    want = records.parse_record(record(TEXT, {"name": "b", "type": ["null", "int"]}))
    fits = lambda ddl: records.differences(StructType.fromDDL(ddl), want, ["k"])
    assert fits("a string, b int, k string") == []
    assert fits("b int, a string, k string") == ["order differs from a on"]
    assert fits("a string, k string") == ["b is missing"]
    assert fits("a string, b string, k string, c int") == ["c is not in the record", "b is string, not int"]


def test_rows_are_matched_by_name(spark):
    want = records.parse_record(
        record(TEXT, {"name": "b", "type": "int", "default": 7}, {"name": "c", "type": {"type": "array", "items": "int"}, "default": [1, 2]})
    )
    df = spark.createDataFrame([("k1", "x")], "k string, a string")
    out = records.resolve_record(df, want, ["k"])
    assert out.dtypes == [("a", "string"), ("b", "int"), ("c", "array<int>"), ("k", "string")]
    assert tuple(out.first()) == ("x", 7, [1, 2], "k1")
    with pytest.raises(records.RecordError, match="k is missing"):
        records.resolve_record(df.drop("k"), want, ["k"])
    with pytest.raises(records.RecordError, match="a is int"):
        records.resolve_record(df.selectExpr("k", "1 AS a"), want, ["k"])


@pytest.fixture
def landing(spark, tmp_path):
    """A workload table, and how to land it by a record."""
    env, base = f"a{uuid.uuid4().hex[:8]}", str(tmp_path)
    db = catalogue.ensure_layer_db(spark, env, "workload", base)
    names = [f.name for f in schemas.LANDING_SCHEMA.fields]
    spark.createDataFrame([tuple(names)], schemas.LANDING_SCHEMA).write.saveAsTable(f"{db}.w")

    def run(*fields):
        path = str(tmp_path / uuid.uuid4().hex)
        records.write_record(spark, record(*fields), path)
        return layers.run_landing(spark, env, base, f"{db}.w", schema_file=path)

    return run, [n for n in names if n != LANDING_PARTITION]


def test_landing_by_a_record(spark, landing):
    run, names = landing
    fields = [{"name": n, "type": ["null", "string"], "default": None} for n in names]
    table = run(*fields)
    assert spark.table(table).columns == [*names, LANDING_PARTITION]
    assert run(*fields) == table  # fits itself
    with pytest.raises(records.RecordError, match="order differs"):
        run(*reversed(fields))
    with pytest.raises(records.RecordError, match="is not in the record"):
        run(*fields[1:])
    with pytest.raises(records.RecordError, match="is missing"):
        run(*fields, {"name": "more", "type": ["null", "string"], "default": None})
    assert spark.table(table).count() == 1


def test_landing_without_a_field(spark, landing):
    run, names = landing
    fields = [{"name": n, "type": ["null", "string"], "default": None} for n in names]
    with pytest.raises(records.RecordError, match="more is missing and has no default"):
        run(*fields, {"name": "more", "type": "string"})
    table = run(*fields, {"name": "more", "type": "string", "default": "none"})
    assert spark.table(table).first()["more"] == "none"
