"""Training from the lake: history from the first source there is, plus what reviewers have labelled."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import ensemble
from ..operators.clean import unqualify_columns
from ..operators.features import with_feedback
from ..operators.review import resolve_feedback, validated_feedback, with_latest
from ..sources.readers import EmptyInput, first_available, read_csv_inferred


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` by name, in its order and types; a missing one is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing: {', '.join(missing)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def history(spark: SparkSession, schema: StructType, table: str | None, csv: str | None = None) -> DataFrame:
    """Enriched claims of the catalogue table, or else of the CSV export, in declared columns.

    Either may carry ``table.`` before its column names, as query results do.  Without
    any source there is nothing to train on, which is an error.
    """
    found = first_available(spark, table, partial(read_csv_inferred, path=csv) if csv else None)
    if found is None:
        raise EmptyInput("no training source: neither the table nor the file is there")
    return typed(unqualify_columns(found), schema)


def training_source(
    spark: SparkSession, schema: StructType, table: str | None, csv: str | None = None,
    evaluations: DataFrame | None = None, feedback: DataFrame | None = None, latest: bool = False,
) -> DataFrame:
    """What a training run reads: history and, where there are any, the labelled evaluations.

    ``latest``: ``feedback`` is a feedback state, one row per case, and is not reduced
    again.
    """
    claims = history(spark, schema, table, csv)
    if evaluations is None:
        return claims
    if feedback is not None:
        evaluations = (with_latest if latest else resolve_feedback)(evaluations, feedback)
    return with_feedback(claims, validated_feedback(evaluations))


def run_training(
    spark: SparkSession, out: str, schema: StructType, table: str | None, csv: str | None = None,
    evaluations: DataFrame | None = None, feedback: DataFrame | None = None, latest: bool = False,
    params: ensemble.Params = ensemble.Params(), **options,
) -> ensemble.Artifact:
    """Train on the first source there is plus feedback, and save the model to ``out``.

    Fits that are done are kept beside the model until it is saved, so a run whose
    driver was lost goes on where it was.
    """
    rows = training_source(spark, schema, table, csv, evaluations, feedback, latest)
    artifact = ensemble.train(rows, params, **{"journal": f"{out.rstrip('/')}.journal", **options})
    ensemble.save_artifact(artifact, spark, out)
    return artifact
