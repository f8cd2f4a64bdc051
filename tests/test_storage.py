"""Sources, sinks and layers."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from claimflow import fixtures
from claimflow.fixed_values import LANDING_PARTITION, RAW_COLUMNS
from claimflow.operators import clean, derive, kpi, localize
from claimflow.plans import layers
from claimflow.sources import catalogue, readers, schemas, scratch, writers


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "out")


def rows(spark, data, schema="k string, v int"):
    return spark.createDataFrame(data, schema)


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_text_round_trip_keeps_everything(spark, path):
    data = [("José|Ñ", "  x "), (None, "a\rb"), ("", "é\"q\""), ("\\", "tab\t")]
    df = rows(spark, data, "k string, v string")
    writers.write_text_layer(df, path)
    assert as_set(readers.read_delimited(spark, path, df.schema)) == sorted(map(tuple, data), key=repr)
    text = b"".join(open(f, "rb").read() for f in glob.glob(f"{path}/*.csv"))
    assert b"\xe9" in text and "é".encode() not in text


def test_raw_text_file_reads_as_declared(spark, tmp_path):
    f = tmp_path / "claims.data"
    cells = {"Month": "Jan", "Age": "\\N", "Make": "Citroën"}
    f.write_bytes(("|".join(RAW_COLUMNS) + "\n" + "|".join(cells.get(c, "x") for c in RAW_COLUMNS) + "\n").encode("latin-1"))
    r = readers.read_delimited(spark, str(f)).first()
    assert (r.Month, r.Age, r.Make, r.BasePolicy) == ("Jan", None, "Citroën", "x")


def test_windows_line_ends(spark, tmp_path):
    f = tmp_path / "claims.data"
    lines = ["A|B", "1|x", "2|\\N", "3|", "4|a\rb", '5|"q"']
    f.write_bytes("".join(line + "\r\n" for line in lines).encode())
    schema = schemas.StructType.fromDDL("A string, B string")
    assert as_set(readers.read_delimited(spark, str(f), schema)) == [
        ("1", "x"), ("2", None), ("3", None), ("4", "a\rb"), ("5", "q")
    ]


def test_settings_leave_the_callers_alone(spark):
    from claimflow.conf import SETTINGS, tune

    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "9000")
    try:
        assert tune(spark).conf.get(key) == "9000"
    finally:
        spark.conf.set(key, SETTINGS[key])


def test_dynamic_overwrite_leaves_other_partitions(spark, path):
    writers.overwrite_partitions(rows(spark, [("a", 1), ("b", 2), (None, 3)]).select("v", "k"), path, ["k"])
    writers.overwrite_partitions(rows(spark, [("a", 9)]).select("v", "k"), path, ["k"])
    assert as_set(spark.read.schema("v int, k string").parquet(path)) == [(2, "b"), (3, None), (9, "a")]
    parts = writers.list_partitions(spark.read.schema("v int, k string").parquet(path), ["k"])
    assert as_set(parts) == [("k=__HIVE_DEFAULT_PARTITION__",), ("k=a",), ("k=b",)]


def test_replace_table_replaces_all(spark, tmp_path):
    db = catalogue.ensure_layer_db(spark, f"r{uuid.uuid4().hex[:8]}", "curated", str(tmp_path))
    for data in ([("a", 1), ("b", 2)], [("a", 9)]):
        writers.replace_table(rows(spark, data).select("v", "k"), f"{db}.t", ["k"], str(tmp_path / "t"))
    assert as_set(readers.read_layer(spark, f"{db}.t")) == [(9, "a")]
    assert [r.tabla for r in catalogue.list_tables(spark, db).collect()] == ["t"]


def test_dropping_a_database_is_explicit(spark, tmp_path):
    env = f"d{uuid.uuid4().hex[:8]}"
    db = catalogue.ensure_layer_db(spark, env, "workload", str(tmp_path))
    assert db == f"{env}_fraudes_workload"
    rows(spark, [("a", 1)]).write.saveAsTable(f"{db}.t")
    catalogue.ensure_layer_db(spark, env, "workload", str(tmp_path))
    assert spark.catalog.tableExists(f"{db}.t")
    catalogue.ensure_layer_db(spark, env, "workload", str(tmp_path), drop_first=True)
    assert not spark.catalog.tableExists(f"{db}.t")


def test_exports_are_one_file_where_asked(spark, tmp_path):
    df = spark.range(100).repartition(4).selectExpr("id", "cast(id as string) AS s")
    one, many, joined = (str(tmp_path / n) for n in ("one", "many", "joined"))
    writers.export_csv(df, one, single_file=True)
    assert len(glob.glob(f"{one}/*.csv")) == 1
    writers.export_csv(df, many)
    assert len(glob.glob(f"{many}/*.csv")) == 4
    assert readers.read_csv_inferred(spark, many, df.schema).exceptAll(df).isEmpty()
    writers.consolidate_csv(spark, many, joined)
    [single] = glob.glob(f"{joined}/*.csv")
    lines = open(single).read().splitlines()
    assert len(lines) == 101 and lines.count("id,s") == 1


def test_inferred_types(spark, path):
    writers.export_csv(rows(spark, [("a", 1), ("b", 2)]), path)
    assert readers.read_csv_inferred(spark, path).dtypes == [("k", "string"), ("v", "int")]


def test_documents_keep_null_fields(spark, path):
    writers.export_documents(rows(spark, [("a", None)]), path)
    assert "".join(open(f).read() for f in glob.glob(f"{path}/*.json")) == '{"k":"a","v":null}\n'
    with pytest.raises(readers.EmptyInput):
        writers.export_documents(rows(spark, []), path)
    assert spark.read.json(path).count() == 1  # the collection stays
    writers.export_documents(rows(spark, [("b", 2)]), path)
    assert "".join(open(f).read() for f in glob.glob(f"{path}/*.json")) == '{"k":"b","v":2}\n'
    assert glob.glob(f"{path}.writing*") == []


def test_first_available(spark, tmp_path):
    missing = lambda s: s.read.csv(str(tmp_path / "missing"))
    there = lambda s: rows(s, [("a", 1)])
    assert readers.first_available(spark, "no_db.t", None, missing) is None
    assert readers.first_available(spark, "no_db.t", missing, there).count() == 1


def test_formats_have_to_fit(spark, tmp_path):
    assert writers.require_format(spark, "orc") == "orc"
    with pytest.raises(ValueError):
        writers.require_format(spark, "no_such_format")
    db = catalogue.ensure_layer_db(spark, f"f{uuid.uuid4().hex[:8]}", "landing", str(tmp_path))
    writers.require_table_format(spark, f"{db}.t", "avro")  # not there yet
    rows(spark, [("a", 1)]).write.saveAsTable(f"{db}.t")
    writers.require_table_format(spark, f"{db}.t", "parquet")
    with pytest.raises(ValueError, match="parquet"):
        writers.require_table_format(spark, f"{db}.t", "avro")


def test_log_of_batches_and_streams(spark, path):
    schema = "k string, v int"
    assert readers.read_log(spark, path, schema).count() == 0
    writers.append_evaluations(rows(spark, [("a", 1)]), path)
    rows(spark, [("b", 2)]).write.parquet(f"{path}/{readers.LOG_STREAM}")
    assert as_set(readers.read_log(spark, path, schema)) == [("a", 1), ("b", 2)]


def test_partitions_of_a_table(spark, tmp_path):
    db = catalogue.ensure_layer_db(spark, f"p{uuid.uuid4().hex[:8]}", "curated", str(tmp_path))
    writers.replace_table(rows(spark, [("a", 1), (None, 2)]).select("v", "k"), f"{db}.t", ["k"], str(tmp_path / "t"))
    assert as_set(writers.table_partitions(spark, f"{db}.t")) == [("k=__HIVE_DEFAULT_PARTITION__",), ("k=a",)]


def test_schema_mismatch_is_an_error(spark):
    df = rows(spark, [("a", 1)])
    with pytest.raises(ValueError, match="weekofmonth"):
        schemas.require_columns(df, schemas.LANDING_SCHEMA)
    assert schemas.LANDING_SCHEMA.fieldNames()[-1] == LANDING_PARTITION and len(schemas.LANDING_SCHEMA) == 33


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch.scratch_path(spark, "x").startswith(base.rstrip("/"))
    df = rows(spark, [("a", 1)])
    assert as_set(scratch.materialize(df, "m")) == [("a", 1)]


@pytest.mark.parametrize("reuse", ["table", "cache"])
def test_layers_end_to_end_and_again(spark, sf, tmp_path, reuse):
    env, base = f"l{uuid.uuid4().hex[:8]}", str(tmp_path)
    source = str(tmp_path / "source")
    claims = fixtures.claims(spark, sf)
    writers.write_text_layer(claims.toDF(*RAW_COLUMNS), source)
    names = layers.run_all(spark, env, base, source)
    landing = spark.table(names["landing"])
    assert landing.columns[-1] == LANDING_PARTITION
    assert landing.select(*claims.columns).exceptAll(claims).isEmpty() and landing.count() == 1500
    # A second load of the same files gives the same tables.
    workload = layers.run_workload(spark, env, base, source)
    curated, report = layers.run_curated(spark, env, base, layers.run_landing(spark, env, base, workload))
    enriched, kpis = layers.run_functional(spark, env, base, curated, reuse=reuse)
    counts = {r.capa: r.registros for r in kpi.layer_counts({n: spark.table(t) for n, t in names.items()}).collect()}
    assert counts["workload"] == counts["landing"] == 1500
    assert counts["curated"] == counts["enriched"] == spark.table(enriched).count()
    assert tuple(report.first()[:3]) == (1500, counts["curated"], 1500 - counts["curated"])
    assert spark.table(kpis).agg(F.sum("total_reclamos")).first()[0] == counts["curated"]


def test_landing_replaces_only_months_it_is_given(spark, sf, tmp_path):
    env, base = f"m{uuid.uuid4().hex[:8]}", str(tmp_path)
    claims = fixtures.claims(spark, sf)
    db = catalogue.ensure_layer_db(spark, env, "workload", base)
    claims.write.saveAsTable(f"{db}.a")
    claims.filter("monthclaimed = 'Apr'").limit(3).write.saveAsTable(f"{db}.b")
    layers.run_landing(spark, env, base, f"{db}.a")
    landing = spark.table(layers.run_landing(spark, env, base, f"{db}.b"))
    assert landing.filter("monthclaimed = 'Apr'").count() == 3
    assert landing.filter("monthclaimed IS DISTINCT FROM 'Apr'").count() == claims.filter("monthclaimed IS DISTINCT FROM 'Apr'").count()
    assert clean.lower_columns(landing).columns == landing.columns


def failing(spark):
    df = rows(spark, [("c", 3), ("d", 4)]).select(F.when(F.col("v") > 3, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")).alias("v"), "k")
    return df.repartition(2, "k")


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    db = catalogue.ensure_layer_db(spark, f"q{uuid.uuid4().hex[:8]}", "curated", str(tmp_path))
    name, path = f"{db}.t", str(tmp_path / "t")
    first = rows(spark, [("a", 1), (None, 2)]).select("v", "k")
    writers.replace_table(first, name, ["k"], path)
    with pytest.raises(Exception, match="lost"):
        writers.replace_table(failing(spark), name, ["k"], path)
    assert as_set(readers.read_layer(spark, name)) == [(1, "a"), (2, None)]
    writers.replace_table(rows(spark, [("z", 9)]).select("v", "k"), name, ["k"], path)
    assert as_set(readers.read_layer(spark, name)) == [(9, "z")]
    assert as_set(writers.table_partitions(spark, name)) == [("k=z",)]
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    assert len(glob.glob(f"{path}.versions/*")) <= 2  # the former rows are gone; a failed write may leave its folder


@pytest.mark.parametrize("left, want", [(["new", "old"], [(2, "new")]), (["old"], [(1, "old")]), (["t", "new"], [(3, "t")]), (["t", "old"], [(3, "t")]), (["writing", "old"], [(1, "old")])])
def test_replacement_that_ended_half_way(spark, tmp_path, left, want):
    db = catalogue.ensure_layer_db(spark, f"h{uuid.uuid4().hex[:8]}", "curated", str(tmp_path))
    for kind, v in (("old", 1), ("new", 2), ("t", 3), ("writing", 4)):
        if kind in left:
            name = f"{db}.t" if kind == "t" else f"{db}.t__{kind}"
            rows(spark, [(kind, v)]).select("v", "k").write.option("path", str(tmp_path / kind)).partitionBy("k").saveAsTable(name)
    catalogue.recover_table(spark, f"{db}.t")
    assert as_set(readers.read_layer(spark, f"{db}.t")) == want
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_reader_puts_a_lost_table_right(spark, tmp_path):
    db = catalogue.ensure_layer_db(spark, f"l{uuid.uuid4().hex[:8]}", "curated", str(tmp_path))
    rows(spark, [("a", 1)]).write.saveAsTable(f"{db}.t__new")
    assert as_set(readers.read_layer(spark, f"{db}.t")) == [("a", 1)]


def test_load_counts_read_nothing_again(spark, sf, tmp_path):
    source, base = str(tmp_path / "source"), str(tmp_path)
    writers.write_text_layer(fixtures.claims(spark, sf).toDF(*RAW_COLUMNS), source)
    env, counts = f"c{uuid.uuid4().hex[:8]}", {}
    landing = layers.run_landing(spark, env, base, layers.run_workload(spark, env, base, source, counts=counts), counts=counts)
    _, report = layers.run_curated(spark, env, base, landing, counts)
    plans = report._jdf.queryExecution().toString() + layers.load_counts(spark, counts)._jdf.queryExecution().toString()
    assert "Scan parquet" not in plans and "Scan csv" not in plans
    want = kpi.quality_report(spark.table(landing))
    assert report.columns == want.columns and as_set(report) == as_set(want)
    n = fixtures.claims(spark, sf).count()
    assert as_set(layers.load_counts(spark, counts)) == sorted([("workload", n), ("landing", n), ("curated", want.first().total_curated)])


def test_scratch_tables_go_with_their_block(spark):
    one = rows(spark, [("a", 1)])

    with scratch.temporaries(spark):
        outer = scratch.materialize(one, "outer")
        with scratch.temporaries(spark):
            inner, kept = scratch.materialize(one, "inner"), scratch.materialize(one, "kept", keep=True)
            files = {n: df.inputFiles()[0] for n, df in (("outer", outer), ("inner", inner), ("kept", kept))}
        assert not there_file(files["inner"]) and there_file(files["kept"]) and kept.count() == 1
        last = scratch.materialize(one, "last", keep=True)
    assert not there_file(files["outer"]) and not there_file(files["kept"]) and last.count() == 1
    with pytest.raises(ValueError), scratch.temporaries(spark):
        lost = scratch.materialize(one, "lost").inputFiles()[0]
        raise ValueError
    assert not there_file(lost)
    assert scratch.materialize(one, "free").count() == 1


def there_file(name):
    return os.path.exists(name.removeprefix("file://"))


def test_consolidation_takes_the_whole_curated_table(spark, sf):
    rows = entry.queries()["consolidate_csv"](spark, sf)
    assert rows.count() == localize.curate(fixtures.claims(spark, sf)).count() and len(rows.columns) == 34


def test_exports_of_claims_are_packed(spark, sf, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS packed_exports")
    try:
        rich = derive.enrich(localize.curate(fixtures.claims(spark, sf)), as_of=F.lit("2024-01-02 03:04:05").cast("timestamp"))
        rich.limit(300).write.mode("overwrite").saveAsTable("packed_exports.rich")
        kpi.segment_kpis(spark.table("packed_exports.rich")).write.mode("overwrite").saveAsTable("packed_exports.kpis")
        layers.run_exports(spark, "packed_exports.rich", "packed_exports.kpis", str(tmp_path))
        details = [str(tmp_path / "csv" / "fraudes_enriquecido"), str(tmp_path / "documents" / "fraudes_detalle")]
        for path in details:
            files = [f for f in glob.glob(f"{path}/*") if not f.endswith("_SUCCESS")]
            assert files and all(f.endswith(".gz") for f in files)
        rows = spark.table("packed_exports.rich")
        for back in (readers.read_csv_inferred(spark, details[0], rows.schema), spark.read.schema(rows.schema).json(details[1])):
            assert back.count() == 300 and back.exceptAll(rows).isEmpty()
        assert len(glob.glob(f"{tmp_path}/csv/metricas_fraude/*.csv")) == 1
    finally:
        spark.sql("DROP DATABASE packed_exports CASCADE")


def test_a_packed_file_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "PACKED_ROWS", 10)
    writers.export_csv(spark.range(0, 95, 1, 1), str(tmp_path / "csv"), compression="gzip")
    assert len(glob.glob(f"{tmp_path}/csv/*.csv.gz")) == 10 and spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 95


def test_partitioned_writes_do_not_sort_their_rows(spark):
    spark.sql("CREATE TABLE unsorted_write (v INT, k STRING) USING parquet PARTITIONED BY (k)")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO unsorted_write SELECT CAST(id AS INT), CAST(id % 3 AS STRING) FROM range(9)").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE unsorted_write")
