"""Queries that write with a sink and return what a source reads back."""

from __future__ import annotations

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from .. import fixtures
from ..fixed_values import CURATED_PARTITION, LANDING_PARTITION, RAW_COLUMNS
from ..operators import clean, kpi, review
from ..sources import catalogue, readers, records, schemas, scratch, writers
from ..streaming import arrivals, state
from .claim_queries import curated, enriched, fixed_time, raw
from .layers import load_counts, run_all, run_curated, run_exports, run_functional, run_landing, run_workload
from .registry import query


def _raw_files(spark, sf, name):
    """Raw claims as delimited files, columns named as in a raw file."""
    path = scratch.scratch_path(spark, name)
    writers.write_text_layer(raw(spark, sf).toDF(*RAW_COLUMNS), path)
    return path


def _env(path: str) -> str:
    """A database prefix no other run uses."""
    return "t" + path[-12:]


@query("read_delimited", "SELECT * FROM claims")
def _(spark, sf):
    return clean.lower_columns(readers.read_delimited(spark, _raw_files(spark, sf, "delimited")))


@query("write_text_layer", "SELECT * FROM curated")
def _(spark, sf):
    path = scratch.scratch_path(spark, "text-layer")
    rows = curated(spark, sf)
    # A second write replaces the first in full.
    writers.write_text_layer(rows.filter("anio < 1995"), path)
    writers.write_text_layer(rows, path)
    return readers.read_delimited(spark, path, schemas.CURATED_SCHEMA)


@query("read_layer", "SELECT * FROM curated")
def _(spark, sf):
    base = scratch.scratch_path(spark, "layer")
    db = catalogue.ensure_layer_db(spark, _env(base), "curated", base)
    name = f"{db}.fraudes"
    writers.replace_table(curated(spark, sf), name, [CURATED_PARTITION], catalogue.table_location(base, db, "fraudes"))
    return readers.read_layer(spark, name)


@query("replace_table", "SELECT * FROM curated WHERE anio >= 1995")
def _(spark, sf):
    base = scratch.scratch_path(spark, "replaced")
    db = catalogue.ensure_layer_db(spark, _env(base), "curated", base)
    name, path = f"{db}.fraudes", catalogue.table_location(base, db, "fraudes")
    rows = curated(spark, sf)
    # The second write replaces the whole table, months it does not hold too.
    writers.replace_table(rows, name, [CURATED_PARTITION], path)
    writers.replace_table(rows.filter("anio >= 1995"), name, [CURATED_PARTITION], path)
    return readers.read_layer(spark, name)


@query("replace_table_after_failure", "SELECT * FROM curated")
def _(spark, sf):
    # A write that fails half way leaves the rows there were.
    base = scratch.scratch_path(spark, "replaced")
    db = catalogue.ensure_layer_db(spark, _env(base), "curated", base)
    name, path = f"{db}.fraudes", catalogue.table_location(base, db, "fraudes")
    rows = curated(spark, sf)
    writers.replace_table(rows, name, [CURATED_PARTITION], path)
    bad = F.when(F.col("anio") >= 1995, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("anio"))
    try:
        writers.replace_table(rows.withColumn("anio", bad), name, [CURATED_PARTITION], path)
    except SparkRuntimeException:
        return readers.read_layer(spark, name)
    raise AssertionError("the write was to fail")


@query("write_layer", f"SELECT * FROM claims")
def _(spark, sf):
    path = scratch.scratch_path(spark, "landing")
    rows = clean.partition_last(raw(spark, sf), LANDING_PARTITION)
    writers.write_layer(writers.rebalanced(rows, [LANDING_PARTITION]), path, [LANDING_PARTITION])
    return spark.read.schema(schemas.LANDING_SCHEMA).parquet(path)


@query(
    "overwrite_partitions",
    "SELECT * FROM claims WHERE monthclaimed IS DISTINCT FROM 'Apr' UNION ALL "
    "SELECT * FROM claims WHERE monthclaimed = 'Apr' AND sex = 'Female'",
)
def _(spark, sf):
    path = scratch.scratch_path(spark, "dynamic")
    rows = clean.partition_last(raw(spark, sf), LANDING_PARTITION)
    writers.overwrite_partitions(rows, path, [LANDING_PARTITION])
    april = rows.filter((F.col(LANDING_PARTITION) == "Apr") & (F.col("sex") == "Female"))
    writers.overwrite_partitions(april, path, [LANDING_PARTITION])
    return spark.read.schema(schemas.LANDING_SCHEMA).parquet(path)


@query(
    "list_partitions",
    "SELECT DISTINCT 'monthclaimed=' || coalesce(monthclaimed, '__HIVE_DEFAULT_PARTITION__') AS partition FROM claims",
)
def _(spark, sf):
    base = scratch.scratch_path(spark, "partitions")
    db = catalogue.ensure_layer_db(spark, _env(base), "landing", base)
    name = f"{db}.fraudes"
    rows = clean.partition_last(raw(spark, sf), LANDING_PARTITION)
    writers.replace_table(rows, name, [LANDING_PARTITION], catalogue.table_location(base, db, "fraudes"))
    return writers.table_partitions(spark, name)


def _layers(spark, sf, name):
    """All layers from raw files; their tables and the folder they lie in."""
    base = scratch.scratch_path(spark, name)
    return run_all(spark, _env(base), base, _raw_files(spark, sf, "source"), as_of=fixed_time()), base


@query(
    "layer_tables",
    "SELECT 'workload' AS capa, count(*) AS registros FROM claims UNION ALL SELECT 'landing', count(*) FROM claims "
    "UNION ALL SELECT 'curated', count(*) FROM curated UNION ALL SELECT 'enriched', count(*) FROM enriched "
    "UNION ALL SELECT 'kpis', count(*) FROM kpis",
)
def _(spark, sf):
    tables, _ = _layers(spark, sf, "layers")
    return kpi.layer_counts({layer: readers.read_layer(spark, name) for layer, name in tables.items()})


@query(
    "load_counts",
    "SELECT 'workload' AS capa, count(*) AS registros FROM claims UNION ALL SELECT 'landing', count(*) FROM claims "
    "UNION ALL SELECT 'curated', count(*) FROM curated UNION ALL SELECT 'enriched', count(*) FROM enriched "
    "UNION ALL SELECT 'kpis', count(*) FROM kpis",
)
def _(spark, sf):
    # Counted by the writes of the load; no layer is read again.
    base, counts = scratch.scratch_path(spark, "counted"), {}
    run_all(spark, _env(base), base, _raw_files(spark, sf, "source"), as_of=fixed_time(), counts=counts)
    return load_counts(spark, counts)


def _landing_record(spark):
    """The landing table's record as a file on shared storage."""
    path = scratch.scratch_path(spark, "record")
    fields = schemas.StructType([f for f in schemas.LANDING_SCHEMA.fields if f.name != LANDING_PARTITION])
    records.write_record(spark, records.render_record(fields, "Claim"), path)
    return path


@query("landing_schema_file", "SELECT * FROM claims")
def _(spark, sf):
    # The record declares the table; a second load finds it fitting.
    base = scratch.scratch_path(spark, "landing-record")
    env, record = _env(base), _landing_record(spark)
    workload = run_workload(spark, env, base, _raw_files(spark, sf, "source"))
    for _ in range(2):
        landing = run_landing(spark, env, base, workload, schema_file=record)
    return readers.read_layer(spark, landing)


@query("landing_schema_resolved", "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS basepolicy) FROM claims")
def _(spark, sf):
    # Columns in another order, one too many and one that takes its default.
    base = scratch.scratch_path(spark, "landing-resolved")
    env, record = _env(base), _landing_record(spark)
    db = catalogue.ensure_layer_db(spark, env, "workload", base)
    rows = raw(spark, sf).drop("basepolicy").withColumn("extra", F.lit("x"))
    rows.select(*reversed(rows.columns)).write.saveAsTable(f"{db}.fraudes")
    return readers.read_layer(spark, run_landing(spark, env, base, f"{db}.fraudes", schema_file=record))


@query("layer_landing", "SELECT * FROM claims")
def _(spark, sf):
    tables, _ = _layers(spark, sf, "layers")
    return readers.read_layer(spark, tables["landing"])


@query("layer_enriched", "SELECT * FROM enriched")
def _(spark, sf):
    tables, _ = _layers(spark, sf, "layers")
    return readers.read_layer(spark, tables["enriched"])


@query("layer_kpis", "SELECT * FROM kpis")
def _(spark, sf):
    tables, _ = _layers(spark, sf, "layers")
    return readers.read_layer(spark, tables["kpis"])


@query(
    "curated_run_report",
    "SELECT (SELECT count(*) FROM claims) AS total_origen, (SELECT count(*) FROM curated) AS total_curated, "
    "(SELECT count(*) FROM claims) - (SELECT count(*) FROM curated) AS descartados",
)
def _(spark, sf):
    base = scratch.scratch_path(spark, "curated-run")
    env = _env(base)
    landing = run_landing(spark, env, base, run_workload(spark, env, base, _raw_files(spark, sf, "source")))
    _, report = run_curated(spark, env, base, landing)
    return report.select("total_origen", "total_curated", "descartados")


@query(
    "exports",
    "SELECT 'csv' AS capa, count(*) AS registros FROM enriched UNION ALL SELECT 'csv_kpis', count(*) FROM kpis UNION ALL "
    "SELECT 'documents', count(*) FROM enriched UNION ALL SELECT 'documents_kpis', count(*) FROM kpis",
)
def _(spark, sf):
    return kpi.layer_counts(_exported(spark, sf))


def _exported(spark, sf):
    """What each export holds, read back."""
    tables, base = _layers(spark, sf, "gold")
    run_exports(spark, tables["enriched"], tables["kpis"], base)
    schemas_of = {name: readers.read_layer(spark, tables[name]).schema for name in ("enriched", "kpis")}
    return {
        "csv": readers.read_csv_inferred(spark, f"{base}/csv/fraudes_enriquecido", schemas_of["enriched"]),
        "csv_kpis": readers.read_csv_inferred(spark, f"{base}/csv/metricas_fraude", schemas_of["kpis"]),
        "documents": spark.read.schema(schemas_of["enriched"]).json(f"{base}/documents/fraudes_detalle"),
        "documents_kpis": spark.read.schema(schemas_of["kpis"]).json(f"{base}/documents/metricas_kpi"),
    }


@query("exports_csv_rows", "SELECT * FROM enriched")
def _(spark, sf):
    return _exported(spark, sf)["csv"]


@query("exports_document_rows", "SELECT * FROM enriched")
def _(spark, sf):
    return _exported(spark, sf)["documents"]


@query("functional_layer", "SELECT * FROM kpis")
def _(spark, sf):
    base = scratch.scratch_path(spark, "functional")
    env = _env(base)
    db = catalogue.ensure_layer_db(spark, env, "curated", base)
    source = f"{db}.fraudes"
    writers.replace_table(curated(spark, sf), source, [CURATED_PARTITION], catalogue.table_location(base, db, "fraudes"))
    _, kpis = run_functional(spark, env, base, source, as_of=fixed_time())
    return readers.read_layer(spark, kpis)


@query("functional_layer_cached", "SELECT * FROM enriched")
def _(spark, sf):
    base = scratch.scratch_path(spark, "functional")
    env = _env(base)
    db = catalogue.ensure_layer_db(spark, env, "curated", base)
    source = f"{db}.fraudes"
    writers.replace_table(curated(spark, sf), source, [CURATED_PARTITION], catalogue.table_location(base, db, "fraudes"))
    rich, _ = run_functional(spark, env, base, source, as_of=fixed_time(), reuse="cache")
    return readers.read_layer(spark, rich)


@query(
    "ensure_layer_db",
    "SELECT 'fraudes' AS tabla, count(*) AS registros FROM curated UNION ALL SELECT 'metricas_fraude', count(*) FROM kpis",
)
def _(spark, sf):
    base = scratch.scratch_path(spark, "databases")
    db = catalogue.ensure_layer_db(spark, _env(base), "functional", base, drop_first=True)
    for table, rows in (("fraudes", curated(spark, sf)), ("metricas_fraude", kpi.segment_kpis(enriched(spark, sf)))):
        writers.replace_table(rows, f"{db}.{table}", [CURATED_PARTITION], catalogue.table_location(base, db, table))
    counts = kpi.layer_counts({t.tabla: spark.table(f"{db}.{t.tabla}") for t in catalogue.list_tables(spark, db).collect()})
    return counts.withColumnRenamed("capa", "tabla")


@query("ensure_layer_db_rows", "SELECT * FROM kpis")
def _(spark, sf):
    # Dropping and making the database anew leaves only what is written afterwards.
    base = scratch.scratch_path(spark, "databases")
    env = _env(base)
    kpis = kpi.segment_kpis(enriched(spark, sf))
    for rows in (kpis.limit(1), kpis):
        db = catalogue.ensure_layer_db(spark, env, "functional", base, drop_first=True)
        writers.replace_table(rows, f"{db}.kpis", [CURATED_PARTITION], catalogue.table_location(base, db, "kpis"))
    return readers.read_layer(spark, f"{db}.kpis")


@query("export_csv", "SELECT * FROM kpis")
def _(spark, sf):
    path = scratch.scratch_path(spark, "export")
    kpis = kpi.segment_kpis(enriched(spark, sf))
    writers.export_csv(kpis, path, single_file=True)
    return readers.read_csv_inferred(spark, path, schema=kpis.schema)


@query("export_csv_parts", "SELECT * FROM curated")
def _(spark, sf):
    # A table that grows with the claims stays in as many files as tasks write it.
    path = scratch.scratch_path(spark, "parts")
    rows = curated(spark, sf)
    writers.export_csv(rows, path)
    return readers.read_csv_inferred(spark, path, schema=rows.schema)


@query("consolidate_csv", "SELECT * FROM curated")
def _(spark, sf):
    # One file is written by one task, whatever it holds; that task keeps no rows.
    parts, out = scratch.scratch_path(spark, "parts"), scratch.scratch_path(spark, "consolidated")
    rows = curated(spark, sf)
    writers.export_csv(rows, parts, single_file=False)
    writers.consolidate_csv(spark, parts, out)
    return readers.read_csv_inferred(spark, out, schema=rows.schema)


# Inference sees counts as int, amounts without fraction as int, rates as double.
@query(
    "read_csv_inferred",
    "SELECT * REPLACE (CAST(total_reclamos AS INT) AS total_reclamos, CAST(total_fraudes AS INT) AS total_fraudes, "
    "CAST(kpi_perdidas_evitadas_usd AS INT) AS kpi_perdidas_evitadas_usd) FROM kpis",
)
def _(spark, sf):
    path = scratch.scratch_path(spark, "inferred")
    writers.export_csv(kpi.segment_kpis(enriched(spark, sf)), path)
    return readers.read_csv_inferred(spark, path)


@query("first_available_table", "SELECT * FROM curated")
def _(spark, sf):
    base = scratch.scratch_path(spark, "first-table")
    db = catalogue.ensure_layer_db(spark, _env(base), "curated", base)
    name = f"{db}.fraudes"
    writers.replace_table(curated(spark, sf), name, [CURATED_PARTITION], catalogue.table_location(base, db, "fraudes"))
    return readers.first_available(spark, name, lambda s: curated(s, sf).limit(0))


@query("first_available", "SELECT * FROM curated")
def _(spark, sf):
    path = scratch.scratch_path(spark, "fallback")
    rows = curated(spark, sf)
    writers.export_csv(rows, path, single_file=False)
    return readers.first_available(
        spark, "no_such_db.fraudes_enriquecido", lambda s: readers.read_csv_inferred(s, path, schema=rows.schema)
    )


@query("export_documents", "SELECT * FROM kpis")
def _(spark, sf):
    path = scratch.scratch_path(spark, "documents")
    kpis = kpi.segment_kpis(enriched(spark, sf))
    writers.export_documents(kpis, path)
    return spark.read.schema(kpis.schema).json(path)


@query("require_rows", "SELECT count(*) AS registros FROM claims")
def _(spark, sf):
    return readers.require_rows(raw(spark, sf)).agg(F.count(F.lit(1)).alias("registros"))


@query("append_evaluations", "SELECT * FROM evals UNION ALL SELECT * FROM evals WHERE ml_prediccion = 1")
def _(spark, sf):
    path = scratch.scratch_path(spark, "evaluations")
    rows = fixtures.evaluations(spark, sf)
    writers.append_evaluations(rows, path)
    writers.append_evaluations(rows.filter("ml_prediccion = 1"), path)
    return readers.read_log(spark, path, rows.schema)


@query("log_batch_and_stream", "SELECT * FROM evals UNION ALL SELECT * FROM evals WHERE ml_prediccion = 1")
def _(spark, sf):
    # A stream and a batch append to one log; neither hides the other's rows.
    arriving, log, state = (scratch.scratch_path(spark, n) for n in ("arriving", "log", "state"))
    rows = fixtures.evaluations(spark, sf)
    rows.write.parquet(arriving)
    arrivals.run_stream(spark, arriving, f"{log}/{readers.LOG_STREAM}", state, rows.schema, lambda df: df)
    writers.append_evaluations(rows.filter("ml_prediccion = 1"), log)
    return readers.read_log(spark, log, rows.schema)


@query("validated_feedback", "SELECT * FROM resolved WHERE fraude_detectado IS NOT NULL")
def _(spark, sf):
    resolved = review.resolve_feedback(fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf))
    return review.validated_feedback(scratch.materialize(resolved, "resolved"))


@query("resolve_feedback_bucketed", "SELECT * FROM resolved")
def _(spark, sf):
    # Evaluations lie in buckets of their case: only labels are shuffled.
    base = scratch.scratch_path(spark, "bucketed")
    db = catalogue.ensure_layer_db(spark, _env(base), "evaluations", base)
    name, buckets = f"{db}.evaluaciones", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writers.write_bucketed(fixtures.evaluations(spark, sf), name, "case_id", buckets, catalogue.table_location(base, db, "evaluaciones"))
    return review.resolve_feedback(readers.read_layer(spark, name), fixtures.feedback(spark, sf))


@query("feedback_state", "SELECT case_id, label, fecha_validacion, event_id FROM latest_events")
def _(spark, sf):
    # Two arrivals and a batch given once more leave the last label of each case.
    arriving, kept, checkpoint = (scratch.scratch_path(spark, n) for n in ("labels", "state", "state-checkpoint"))
    rows = fixtures.feedback(spark, sf)
    late = F.pmod(F.col("event_id"), F.lit(3)) == 0
    for part in (rows.filter(late), rows.filter(~late)):  # older and newer labels in either
        part.write.mode("append").parquet(arriving)
        arrivals.feedback_state_stream(spark, arriving, kept, checkpoint)
    state.merge_feedback(rows.filter(~late), 1, kept)
    state.vacuum_feedback(spark, kept)
    return state.feedback_state(spark, kept)


@query("resolve_feedback_state", "SELECT * FROM resolved")
def _(spark, sf):
    # The state is one row per case already: evaluations meet it without an aggregate.
    kept = scratch.scratch_path(spark, "state")
    state.merge_feedback(fixtures.feedback(spark, sf), 0, kept)
    return review.with_latest(fixtures.evaluations(spark, sf), state.feedback_state(spark, kept))


def _arrived_claims(spark, sf):
    """Folders of enriched claims and of KPI partials after two arrivals."""
    arriving, out, partials, checkpoint = (scratch.scratch_path(spark, n) for n in ("claims", "enriched", "partials", "claims-checkpoint"))
    rows = raw(spark, sf)
    early = F.col("sex") == "Female"  # segments get claims from both arrivals
    for part in (rows.filter(early), rows.filter(~early)):
        part.write.mode("append").parquet(arriving)
        arrivals.claims_stream(spark, arriving, out, partials, checkpoint, as_of=fixed_time())
    return out, partials


@query("segment_kpis_arriving", "SELECT * FROM kpis")
def _(spark, sf):
    _, partials = _arrived_claims(spark, sf)
    return arrivals.arrived_kpis(spark, partials)


@query("claims_stream", "SELECT * FROM enriched")
def _(spark, sf):
    out, _ = _arrived_claims(spark, sf)
    return spark.read.schema(enriched(spark, sf).schema.add(arrivals.BATCH, "long")).parquet(out).drop(arrivals.BATCH)
