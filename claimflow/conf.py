"""Session settings the engine is built for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All are runtime SQL settings, so they also apply to a running session.
SETTINGS = {
    # Wide projections compile to methods beyond 8,000 bytes, which the JVM only
    # interprets.  Above this limit Spark evaluates them in smaller, compiled pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffles are cut to the data at run time: hot keys split, small parts merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to the open file of their month.  Without this, each writing task first sorts
    # all its rows by month, and a task reads millions of them from compressed files.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings, leaving those the session already sets."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark
