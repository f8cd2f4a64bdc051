"""The corpus pipeline: language ID, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, language, lines, packing, simhash
from claimflow.llm.common import prepare, table
from claimflow.llm.queries import word_tokenizer
from claimflow.sources.scratch import scratch_path

LEAST_SCORE = 0.5  # posterior of the predicted language below which a text is rejected
# Near duplicates are texts whose fingerprints link by the operator's own contract.
SHINGLE = simhash.SHINGLE
RADIUS = simhash.RADIUS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts whose language is in doubt.

    Null and empty texts go.  Repeated rows are judged alike; very long texts are read
    whole, in blocks; extra columns stay as they are; an empty table gives no rows.
    """
    prepare(spark)
    rows = docs.select(F.struct("*").alias("doc"), "text")  # so that no column of the input meets a new one
    found = language.predict(rows, language.fit(docs), keep=["doc"])
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(known).select("doc.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines; documents that had lines and have none left go.

    Null and empty texts stay as they are.  Of repeated rows and tied lines the earliest
    by key keeps its lines; very long texts are cut line by line; extra columns stay.
    """
    return lines.line_dedup(docs, drop_emptied=True)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest key.

    Texts without words, null ones too, are copies of one another.  Of repeated rows one
    stays; very long texts are hashed in blocks; extra columns stay as they are.
    """
    prepare(spark)
    return simhash.near_dedup(docs, shingle=SHINGLE, radius=RADIUS)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of test items; documents that are mostly such passages go.

    Null and empty texts stay.  Repeated rows are cut alike; very long texts are read as
    streams of words; without test items nothing changes; extra columns stay.
    """
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences.

    A null or empty text is the end id alone, a very long one several pieces; repeated
    rows are packed each; an empty table gives no rows; extra columns are left out.
    """
    prepare(spark)
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("decontamination", remove_benchmarks),
    ("packing", pack),
]

# Bayes scores, fingerprints and packing are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
