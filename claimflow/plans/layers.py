"""The four layers, each a read, one transform and a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import CURATED_PARTITION, LANDING_PARTITION
from ..operators.clean import lower_columns, partition_last
from ..operators.derive import enrich
from ..operators.kpi import observe_quality, quality_row, segment_kpis, top_segments
from ..operators.localize import curate
from ..sources.catalogue import ensure_layer_db, table_location
from ..sources.readers import RAW_OPTIONS, read_delimited, read_layer
from ..sources.records import read_record, render_record, require_record, resolve_record
from ..sources.schemas import LANDING_SCHEMA, require_columns
from ..sources.writers import (
    export_csv,
    export_documents,
    overwrite_partitions,
    rebalanced,
    replace_table,
    require_format,
    require_table_format,
    write_text_layer,
)

TABLE = "fraudes"
ENRICHED_TABLE = "fraudes_enriquecido"
KPI_TABLE = "metricas_fraude"


# What a load's writes count as they go: an observation per layer.
Counts = dict[str, Observation]


def _counted(df: DataFrame, layer: str, counts: Counts | None) -> DataFrame:
    """``df``, whose rows the write that takes them counts for ``layer``."""
    if counts is None:
        return df
    counts[layer] = Observation()
    return df.observe(counts[layer], F.count(F.lit(1)).alias("registros"))


def load_counts(spark: SparkSession, counts: Counts) -> DataFrame:
    """(capa, registros): rows per layer as counted by the writes of a load; nothing is read again."""
    rows = [(layer, seen.get["registros"]) for layer, seen in counts.items()]
    return spark.createDataFrame(rows, "capa string, registros long")


def run_workload(
    spark: SparkSession, env: str, base: str, source_path: str, drop_first: bool = False, counts: Counts | None = None
) -> str:
    """Raw files -> all-text table with real headers.  Returns the table name."""
    db = ensure_layer_db(spark, env, "workload", base, drop_first)
    path = table_location(base, db, TABLE)
    raw = read_delimited(spark, source_path)
    write_text_layer(_counted(raw, "workload", counts), path)
    name = f"{db}.{TABLE}"
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="csv", schema=raw.schema, **RAW_OPTIONS)
    spark.catalog.refreshTable(name)
    return name


def run_landing(
    spark: SparkSession, env: str, base: str, source: str, fmt: str = "parquet", schema_file: str | None = None,
    counts: Counts | None = None,
) -> str:
    """Workload table -> landing table by claim month; only months in the input are replaced.

    ``schema_file`` names an Avro record on shared storage that declares the table, all
    but its partition column.  Rows are matched to it by name: a missing field takes
    its default, one without a default is an error, and so is an existing table whose
    fields or their order differ.  Without a file the declared claim columns hold.

    ``fmt="avro"`` writes row-oriented files where the session has that source; a
    format that the session or the existing table does not have is an error.
    """
    require_format(spark, fmt)
    db = ensure_layer_db(spark, env, "landing", base)
    path = table_location(base, db, TABLE)
    require_table_format(spark, f"{db}.{TABLE}", fmt)
    name = f"{db}.{TABLE}"
    rows = lower_columns(read_layer(spark, source))
    options = {}
    if schema_file is None:
        rows = require_columns(partition_last(rows, LANDING_PARTITION), LANDING_SCHEMA)
    else:
        record = read_record(spark, schema_file)
        if spark.catalog.tableExists(name):
            require_record(spark.table(name).schema, record, [LANDING_PARTITION], name)
        rows = resolve_record(rows, record, [LANDING_PARTITION])
        if fmt == "avro":
            options["avroSchema"] = render_record(record, TABLE)
    # The one shuffle of a load: later layers keep the months files come in.
    counted = _counted(rebalanced(rows, [LANDING_PARTITION]), "landing", counts)
    overwrite_partitions(counted, path, [LANDING_PARTITION], fmt, options)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        f"PARTITIONED BY ({LANDING_PARTITION}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return name


def run_curated(
    spark: SparkSession, env: str, base: str, source: str, counts: Counts | None = None
) -> tuple[str, DataFrame]:
    """Landing table -> curated table, whole table replaced, no shuffle; its name and the load's report.

    The report (rows in, kept, discarded, and broken rules) is counted by the write
    itself, between cleaning and the rules: landing is read once.
    """
    db = ensure_layer_db(spark, env, "curated", base)
    name = f"{db}.{TABLE}"
    seen = Observation()
    curated = curate(read_layer(spark, source), check=lambda cleaned: observe_quality(cleaned, seen))
    replace_table(_counted(curated, "curated", counts), name, [CURATED_PARTITION], table_location(base, db, TABLE))
    return name, quality_row(spark, seen)


def run_functional(
    spark: SparkSession, env: str, base: str, source: str, as_of: Column | None = None, reuse: str = "table",
    counts: Counts | None = None,
) -> tuple[str, str]:
    """Curated table -> enriched table and KPI table.

    The KPIs use 10 of the 48 enriched columns.  ``reuse="table"`` reads just
    those back from the Parquet written a moment ago; ``reuse="cache"`` keeps the
    whole enriched frame on the executors instead, for tables that fit there.
    """
    db = ensure_layer_db(spark, env, "functional", base)
    enriched_name, kpi_name = f"{db}.{ENRICHED_TABLE}", f"{db}.{KPI_TABLE}"
    enriched = enrich(read_layer(spark, source), as_of=as_of)
    if reuse == "cache":
        enriched = enriched.cache()
    counted = _counted(enriched, "enriched", counts)
    replace_table(counted, enriched_name, [CURATED_PARTITION], table_location(base, db, ENRICHED_TABLE))
    kpis = segment_kpis(enriched if reuse == "cache" else spark.table(enriched_name))
    replace_table(_counted(kpis, "kpis", counts), kpi_name, [CURATED_PARTITION], table_location(base, db, KPI_TABLE))
    if reuse == "cache":
        enriched.unpersist()
    return enriched_name, kpi_name


def run_all(
    spark: SparkSession, env: str, base: str, source_path: str, as_of: Column | None = None,
    schema_file: str | None = None, counts: Counts | None = None,
) -> dict[str, str]:
    """Raw files through all four layers; returns the table of each.

    ``counts`` is filled with an observation per layer, which ``load_counts`` reads.
    """
    workload = run_workload(spark, env, base, source_path, counts=counts)
    landing = run_landing(spark, env, base, workload, schema_file=schema_file, counts=counts)
    curated, _ = run_curated(spark, env, base, landing, counts)
    enriched, kpis = run_functional(spark, env, base, curated, as_of, counts=counts)
    return {"workload": workload, "landing": landing, "curated": curated, "enriched": enriched, "kpis": kpis}


def run_exports(spark: SparkSession, enriched: str, kpis: str, out: str) -> None:
    """Enriched and KPI tables as CSV and as documents.

    The KPI table, which segments bound, becomes one CSV file; the enriched one as
    many as tasks write it, compressed: its texts and the column names of its documents
    repeat, and would be most of what a load writes.
    """
    for name, table, collection in ((ENRICHED_TABLE, enriched, "fraudes_detalle"), (KPI_TABLE, kpis, "metricas_kpi")):
        rows, packed = read_layer(spark, table), None if name == KPI_TABLE else "gzip"
        export_csv(rows, f"{out}/csv/{name}", single_file=name == KPI_TABLE, compression=packed)
        export_documents(rows, f"{out}/documents/{collection}", compression=packed)


def fraud_hotspots(raw: DataFrame, n: int = 10) -> DataFrame:
    """Raw claims -> the n segments with the highest fraud rate, as one plan."""
    return top_segments(segment_kpis(enrich(curate(lower_columns(raw)))), n)
