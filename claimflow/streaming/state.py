"""The last label of each case as a table that arriving batches update.

Cases are dealt to a fixed number of buckets.  A batch reads the buckets its cases are
in, merges and writes them anew under its own number; the others are not touched.  A
commit, written last, says which buckets a batch has written.  Readers take each
bucket from its last commit, so they never see half a batch, and a batch given twice
starts from the same earlier commits and ends in the same files.

    state/data/version=<batch>/bucket=<n>/     rows of a bucket as of a batch
    state/commits/version=<batch>/             the buckets it wrote
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.review import latest_feedback
from ..sources.schemas import FEEDBACK_SCHEMA
from ..sources.scratch import delete_path
from ..sources.writers import rebalanced

BUCKETS = 64  # of a new state; one that exists keeps its number
_COMMIT = "bucket int, buckets int, version long"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, state: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT).parquet(f"{state}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def _paths(spark: SparkSession, state: str, commits: DataFrame) -> list[str]:
    """Where each bucket's rows lie; as many rows as buckets come to the driver."""
    last = commits.groupBy("bucket").agg(F.max("version").alias("version")).collect()
    return [f"{state}/data/version={r.version}/bucket={r.bucket}" for r in sorted(last)]


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], FEEDBACK_SCHEMA)
    return spark.read.schema(FEEDBACK_SCHEMA).parquet(*paths)


def merge_feedback(rows: DataFrame, batch: int, state: str, buckets: int = BUCKETS) -> None:
    """Take a batch of labels into the state.

    Labels of one case are combined before they move, so a case with very many weighs
    as much as any other.  Labels without a case are left out.  A batch without rows
    writes nothing.
    """
    spark = rows.sparkSession
    commits = _commits(spark, state)
    known = commits.select("buckets").limit(1).collect()
    if known and known[0].buckets != buckets:
        raise ValueError(f"{state} has {known[0].buckets} buckets, not {buckets}")
    bucket = bucket_of("case_id", buckets)
    given = rows.select("case_id", "fecha_validacion", "label", "event_id").filter(F.col("case_id").isNotNull())
    touched = sorted(r[0] for r in given.select(bucket.alias("bucket")).distinct().collect())
    if not touched:
        return
    # Commits of later batches are passed over: a batch given again starts where it did.
    before = commits.filter((F.col("version") < batch) & F.col("bucket").isin(touched))
    merged = latest_feedback(_rows(spark, _paths(spark, state, before)).unionByName(given), keep_order=True)
    out = rebalanced(merged.withColumn("bucket", bucket), ["bucket"])
    out.write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/data/version={batch}")
    done = spark.createDataFrame([(b, buckets) for b in touched], "bucket int, buckets int")
    done.coalesce(1).write.mode("overwrite").parquet(f"{state}/commits/version={batch}")


def feedback_state(spark: SparkSession, state: str) -> DataFrame:
    """(case_id, fecha_validacion, label, event_id): the last label of each case; the log is not read."""
    return _rows(spark, _paths(spark, state, _commits(spark, state)))


def vacuum_feedback(spark: SparkSession, state: str) -> int:
    """Delete rows of buckets that a later commit has replaced; how many such buckets went.

    Run it when no reader still holds an earlier state and no batch is being repeated.
    """
    commits = _commits(spark, state)
    last = commits.groupBy("bucket").agg(F.max("version").alias("last"))
    stale = commits.join(F.broadcast(last), "bucket").filter("version < last").select("version", "bucket").collect()
    for r in stale:
        delete_path(spark, f"{state}/data/version={r.version}/bucket={r.bucket}")
    return len(stale)
