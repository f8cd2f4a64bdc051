"""Sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .catalogue import recover_table
from .schemas import RAW_SCHEMA

# How raw claim files are delimited and encoded.
# Lines end in \n only, so a stray \r inside a field does not cut its row in two.
RAW_OPTIONS = {
    "sep": "|", "header": "true", "encoding": "ISO-8859-1", "nullValue": "\\N", "emptyValue": "", "lineSep": "\n",
}


def strip_line_end(df: DataFrame) -> DataFrame:
    """Undo what a file with \\r\\n line ends leaves in the last column."""
    field = df.schema.fields[-1]
    if not isinstance(field.dataType, StringType):
        return df
    last = F.col(field.name)
    bare = F.substring(last, F.lit(1), F.length(last) - 1)
    missing = bare.isin("", RAW_OPTIONS["nullValue"])
    return df.withColumn(
        field.name, F.when(~F.endswith(last, F.lit("\r")), last).otherwise(F.when(~missing, bare))
    )


def read_delimited(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, options: dict | None = None
) -> DataFrame:
    """Delimited text with a declared schema, lines ending in either way."""
    return strip_line_end(spark.read.schema(schema).options(**{**RAW_OPTIONS, **(options or {})}).csv(path))


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table; one whose replacement ended half way is put right first."""
    if not spark.catalog.tableExists(name):
        recover_table(spark, name)
    return spark.table(name)


def read_csv_inferred(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """UTF-8 CSV with header; types are inferred only if no schema is declared.

    Inference reads all the data once more, so callers who know it pass one.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


LOG_BATCH, LOG_STREAM = "batch", "stream"  # folders of a log


def read_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All rows of a log: those appended by batches and those that arrived by a stream."""
    out = None
    for part in (LOG_BATCH, LOG_STREAM):
        try:
            rows = spark.read.schema(schema).parquet(f"{path}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def first_available(
    spark: SparkSession, *sources: str | Callable[[SparkSession], DataFrame] | None
) -> DataFrame | None:
    """The first source that exists: a table name or a reader; None if none does."""
    for source in sources:
        if source is None:
            continue
        if isinstance(source, str):
            if spark.catalog.tableExists(source):
                return spark.table(source)
            continue
        try:
            return source(spark)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return None


class EmptyInput(ValueError):
    """Raised where an input has to have rows."""


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Pass a non-empty frame through; stops at the first row found, no count."""
    if df.isEmpty():
        raise EmptyInput(f"{what} has no rows")
    return df
