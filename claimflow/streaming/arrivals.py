"""Jobs over arriving files.

All write through the file sink, whose log makes every input row appear once
even when a batch is retried.  ``availableNow`` takes what has arrived and ends;
``files_per_batch`` bounds one batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..fixed_values import CURATED_PARTITION, EVALUATION_INPUTS
from ..operators.clean import lower_columns
from ..operators.derive import enrich
from ..operators.ensemble import Artifact, score
from ..operators.features import form_fields
from ..operators.kpi import kpis_of_partials, merge_partials, segment_partials
from ..operators.localize import curate
from ..operators.review import evaluation_columns
from ..sources.readers import LOG_STREAM, strip_line_end
from ..sources.schemas import FEEDBACK_SCHEMA, FORM_SCHEMA, RAW_SCHEMA
from ..sources.scratch import path_exists
from .state import BUCKETS, merge_feedback

BATCH = "lote"  # folders of a batch


def _arriving(
    spark: SparkSession, in_path: str, schema: StructType | str, fmt: str = "parquet", options: dict | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    files = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    arriving = files.option("maxFilesPerTrigger", files_per_batch).load(in_path)
    return strip_line_end(arriving) if fmt == "csv" else arriving


def run_stream(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    checkpoint: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    fmt: str = "parquet",
    options: dict | None = None,
    files_per_batch: int = 1000,
    partition_by: str | None = None,
) -> None:
    """Take the files that have arrived through ``transform`` and append the result."""
    writer = (
        transform(_arriving(spark, in_path, schema, fmt, options, files_per_batch))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    (writer.partitionBy(partition_by) if partition_by else writer).start().awaitTermination()


def run_batches(
    spark: SparkSession, in_path: str, checkpoint: str, handle: Callable[[DataFrame, int], None], **source
) -> None:
    """Give the files that have arrived to ``handle(rows, batch id)``, batch by batch.

    A batch that failed is given again under its id, so ``handle`` has to leave the
    same state however often it sees one.
    """
    query = (
        _arriving(spark, in_path, **source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def own_output(spark: SparkSession, path: str, checkpoint: str) -> None:
    """An error unless ``path`` belongs to this stream, or to none yet.

    Batches are told apart by their numbers, which the checkpoint counts.  Another
    checkpoint, or one that was lost, would give old numbers to new rows.
    """
    marker = f"{path.rstrip('/')}.stream"
    if not path_exists(spark, marker):
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(marker)
        return
    owner = spark.read.text(marker).first().value
    if owner != checkpoint:
        raise ValueError(f"{path} is written by the stream of {owner}")
    if not path_exists(spark, checkpoint):
        raise ValueError(f"the checkpoint of {path} is gone: write to a new folder")


def enrich_stream(
    spark: SparkSession, in_path: str, out_path: str, checkpoint: str, as_of: Column | None = None, **source
) -> None:
    """Arriving raw claims -> curated and enriched, with the rule score, by month like the table."""
    source.setdefault("schema", RAW_SCHEMA)
    run_stream(
        spark, in_path, out_path, checkpoint, partition_by=CURATED_PARTITION,
        transform=lambda df: enrich(curate(lower_columns(df)), as_of=as_of), **source,
    )


def evaluate_forms(forms: DataFrame, artifact: Artifact, as_of: Column | None = None) -> DataFrame:
    """Scoring forms -> rows of the evaluation log."""
    scored = score(form_fields(forms), artifact)
    return evaluation_columns(scored, as_of).select(
        "case_id", *EVALUATION_INPUTS, "ml_prediccion", "ml_probabilidad_fraude", "nivel_alerta",
        "fraude_detectado", "fecha_evaluacion",
    )


def score_stream(
    spark: SparkSession, in_path: str, out_path: str, checkpoint: str, artifact: Artifact,
    as_of: Column | None = None, **source,
) -> None:
    """Arriving scoring forms -> scored and appended to the evaluation log."""
    source.setdefault("schema", FORM_SCHEMA)
    run_stream(
        spark, in_path, f"{out_path}/{LOG_STREAM}", checkpoint,
        transform=lambda df: evaluate_forms(df, artifact, as_of), **source,
    )


def feedback_stream(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, **source) -> None:
    """Arriving reviewer labels -> append-only feedback log, resolved when read."""
    source.setdefault("schema", FEEDBACK_SCHEMA)
    run_stream(spark, in_path, f"{out_path}/{LOG_STREAM}", checkpoint, transform=lambda df: df, **source)


def claims_stream(
    spark: SparkSession, in_path: str, out_path: str, partials: str, checkpoint: str, as_of: Column | None = None, **source
) -> None:
    """Arriving raw claims -> enriched rows and, per batch, what they add to the segment KPIs.

    The rows of a batch have a folder of their own, its counts and sums too; a repeated
    batch replaces both.  The counts are taken from the rows just written, of which
    they read a few columns, so claims are derived once.
    """
    source.setdefault("schema", RAW_SCHEMA)
    own_output(spark, out_path, checkpoint)
    run_batches(spark, in_path, checkpoint, lambda rows, batch: take_claims(rows, batch, out_path, partials, as_of), **source)


def take_claims(rows: DataFrame, batch: int, out_path: str, partials: str, as_of: Column | None = None) -> None:
    """One batch of raw claims: its enriched rows, then its counts and sums, in place of what it has left before."""
    enriched = enrich(curate(lower_columns(rows)), as_of=as_of)
    folder = f"{out_path}/{BATCH}={batch}"
    enriched.write.mode("overwrite").partitionBy(CURATED_PARTITION).parquet(folder)
    written = rows.sparkSession.read.schema(enriched.schema).parquet(folder)
    segment_partials(written).coalesce(1).write.mode("overwrite").parquet(f"{partials}/{BATCH}={batch}")


def arrived_kpis(spark: SparkSession, partials: str) -> DataFrame:
    """KPIs of all claims that have arrived: the batches' counts and sums added up, claims not read.

    Segments times batches bound what is read.
    """
    return kpis_of_partials(merge_partials(spark.read.parquet(partials).drop(BATCH)))


def feedback_state_stream(
    spark: SparkSession, in_path: str, state: str, checkpoint: str, buckets: int = BUCKETS, **source
) -> None:
    """Arriving reviewer labels -> the last label of each case, kept up to date batch by batch."""
    source.setdefault("schema", FEEDBACK_SCHEMA)
    own_output(spark, state, checkpoint)
    run_batches(spark, in_path, checkpoint, lambda rows, batch: merge_feedback(rows, batch, state, buckets), **source)
