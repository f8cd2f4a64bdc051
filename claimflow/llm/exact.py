"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporaries
from .common import WHITESPACE, Members

PREFIX = 256  # characters hashed in the second step


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " ")


def exact_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", prefix: int = PREFIX, carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, and the ``carry`` columns.

    Texts are equal when they are identical after ``normalised``.  Rows whose length is
    theirs alone stop after the first step, rows whose prefix is theirs alone after the
    second; only what survives both is hashed in full (SHA-256).  Survivors are known
    to the last scan by a filter broadcast while its bytes are bounded, so no text is
    shuffled: what moves are lengths and hashes, combined within each task first.

    ``carry`` names further columns over the row, of which ``norm`` is the normalised
    text; they are computed in the last scan.

    Nulls: a null text is an empty one; null keys sort after all others.  Repeated rows
    with one key: exactly one of them is kept.  Extra columns are not returned, so their
    names cannot clash.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    carry = carry or {}
    base = docs.select(F.col(key).alias("id"), normalised(F.col(text)).alias("norm"))
    sized = base.withColumn("size", F.length("norm"))

    with temporaries(spark):
        # 1: lengths; 2: prefixes of rows whose length is shared.
        keys = materialize(
            sized.select("size", F.xxhash64("size", F.substring("norm", 1, prefix)).alias("head")).groupBy("size", "head").count(),
            "exact-heads",
        )
        shared = keys.groupBy("size").agg(F.sum("count").alias("n")).filter("n > 1").select("size")
        survivors = materialize(keys.filter("count > 1").join(shared, "size", "left_semi").select("head"), "exact-survivors")

        # 3: the full hash, for survivors only.
        head = F.xxhash64("size", F.substring("norm", 1, prefix))
        probed = Members(survivors, "head").mark(sized, head)
        rows = materialize(
            probed.select(
                "id",
                F.monotonically_increasing_id().alias("row"),
                F.when(F.col("hit"), F.sha2("norm", 256)).alias("full"),
                *[c.alias(f"c_{name}") for name, c in carry.items()],
            ),
            "exact-rows",
            keep=True,
        )
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    groups = materialize(
        rows.filter("full IS NOT NULL")
        .groupBy("full")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("full", F.col("first.id").alias("keep"), F.col("first.row").alias("keep_row"), "n"),
        "exact-groups",
    )
    # Both sides are stored tables: a hash with a third of all rows is split at run time.
    # Rows without one, which are most, have no partner and do not meet.
    hashed = rows.filter("full IS NOT NULL").join(groups, "full", "left")
    out = hashed.unionByName(rows.filter("full IS NULL"), allowMissingColumns=True)
    alone = F.col("n").isNull()
    return out.select(
        F.col("id").alias(key),
        F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        *[F.col(f"c_{name}").alias(name) for name in carry],
    )
