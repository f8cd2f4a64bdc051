"""Sinks."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .catalogue import drop_table, location_of, recover_table, rename_table
from .readers import LOG_BATCH, RAW_OPTIONS, EmptyInput
from .scratch import delete_path, move_path, scratch_path

# Written text keeps outer spaces (cleaning is the curated layer's work), and an
# empty text is quoted, since a bare empty field would read back as null.
TEXT_OPTIONS = {
    **RAW_OPTIONS, "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

PACKED_ROWS = 1_000_000


def rebalanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Gather rows by partition key before writing, without hot tasks.

    Adaptive execution splits a key that holds much of the data over several
    tasks and merges small ones, so files come out evenly sized.
    """
    return df.hint("rebalance", *keys)


def write_text_layer(df: DataFrame, path: str) -> None:
    """Delimited text with a real header line in every file.

    Readers that skip a header and readers that do not then agree on the rows.
    """
    df.write.mode("overwrite").options(**TEXT_OPTIONS).csv(path)


def require_format(spark: SparkSession, fmt: str) -> str:
    """``fmt`` if the session can load that source (Avro ships separately), else an error."""
    try:
        spark.read.format(fmt).schema("a string").load(scratch_path(spark, "absent"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise ValueError(f"this session cannot write {fmt}") from e
    except Py4JJavaError as e:  # the source's class is missing
        raise ValueError(f"this session cannot write {fmt}") from e
    return fmt


def require_table_format(spark: SparkSession, name: str, fmt: str) -> None:
    """Refuse to write files of another format below a table that exists."""
    if spark.catalog.tableExists(name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").collect()
        if rows and rows[0].data_type.lower() != fmt.lower():
            raise ValueError(f"{name} holds {rows[0].data_type}, not {fmt}")


def write_layer(df: DataFrame, path: str, keys: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replace a whole layer at a path."""
    writer = df.write.mode("overwrite").format(fmt).option("compression", "snappy")
    (writer.partitionBy(*keys) if keys else writer).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", options: dict[str, str] | None = None
) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .format(fmt)
        .options(**{"compression": "snappy", **(options or {})})
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .save(path)
    )


def replace_table(df: DataFrame, name: str, keys: list[str], path: str | None = None) -> None:
    """Replace a whole partitioned catalogue table, which stays as it is until the new rows are written.

    The rows go to a folder of their own beside ``path``, as a table of another name.
    Only then do two renames in the catalogue put it in the place of the former one,
    whose files are deleted last.  A write that fails leaves the former rows; what a
    driver lost between the renames leaves behind is put right by ``recover_table``,
    which readers and the next replacement call.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    base = path or location_of(spark, name)
    held = f"{name}__writing"
    (
        df.write.mode("overwrite").format("parquet").option("compression", "snappy").partitionBy(*keys)
        .option("path", f"{base}.versions/{uuid.uuid4().hex}").saveAsTable(held)
    )
    rename_table(spark, held, f"{name}__new")  # from here on its rows are whole
    if spark.catalog.tableExists(name):
        rename_table(spark, name, f"{name}__old")
    rename_table(spark, f"{name}__new", name)
    drop_table(spark, f"{name}__old")
    spark.catalog.refreshTable(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str, mode: str = "overwrite") -> None:
    """A catalogue table in buckets of ``key``, sorted by it: joins on the key need no exchange of it.

    Rows are gathered by key first, so a task writes few buckets; a key with very many
    rows is split over several files of its bucket.  Take as many buckets as a shuffle
    has partitions: with fewer a join deals the rows anew, with more it moves the other
    side, aggregated before, a second time.
    """
    writer = rebalanced(df, [key]).write.mode(mode).format("parquet").option("compression", "snappy")
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    """``key=value`` texts of a table's partitions, from the catalogue: no file is opened."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def list_partitions(df: DataFrame, keys: list[str]) -> DataFrame:
    """``key=value`` texts of the partitions present."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(k, F.lit("__HIVE_DEFAULT_PARTITION__"))) for k in keys]
    return df.select(*keys).distinct().select(F.concat_ws("/", *parts).alias("partition"))


def _packed(writer: DataFrameWriter, compression: str | None) -> DataFrameWriter:
    """``writer``, compressing if asked to; files that one task has to read whole hold PACKED_ROWS at most."""
    return writer.options(compression=compression, maxRecordsPerFile=PACKED_ROWS) if compression else writer


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """CSV export with header, as part files that read as one table, or as one file.

    One file means one task writes it: ask for it only where the rows are bounded, as
    those of the KPI table are by its segments.  ``repartition(1)`` keeps the work
    before the write parallel.
    """
    rows = df.repartition(1) if single_file else df
    _packed(rows.write.mode("overwrite").option("header", True), compression).csv(path)


def consolidate_csv(spark: SparkSession, directory: str, out: str) -> None:
    """Part files -> one file with one header, text kept as it is; one task writes it."""
    # Only the header line is looked at; an empty field is told from a null.
    names = spark.read.option("header", True).csv(directory).columns
    text = StructType([StructField(n, StringType(), True) for n in names])
    export_csv(spark.read.option("header", True).schema(text).csv(directory), out, single_file=True)


def export_documents(df: DataFrame, path: str, compression: str | None = None) -> None:
    """One JSON document per line, replacing the collection; null fields are kept.

    The rows are counted as they are written, to a folder beside the collection, which
    takes its place only then: nothing is computed twice, and without a row the
    collection stays and an error says so.
    """
    spark, held, seen = df.sparkSession, f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}", Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    _packed(counted.write.option("ignoreNullFields", False), compression).json(held)
    if not seen.get["rows"]:
        delete_path(spark, held)
        raise EmptyInput("document export has no rows")
    delete_path(spark, path)
    move_path(spark, held, path)


def append_evaluations(df: DataFrame, path: str) -> None:
    """Append scored claims to the evaluation log, beside what streams write there.

    A file sink keeps its own list of files and readers follow it alone, so batches
    have a folder of their own; ``readers.read_log`` reads both.
    """
    df.write.mode("append").parquet(f"{path}/{LOG_BATCH}")
