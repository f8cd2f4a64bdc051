"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use themselves.
CLASHING = ["doc", "id", "th", "fp", "root", "row", "size", "item", "bin", "kept", "score", "lang_pred", "spans", "rest", "gone", "words"]
SENTENCE = "the quick brown fox jumps over the lazy dog near the river bank"
LONG = " ".join(f"w{i}x{i * 7 % 13}" for i in range(40_000))

ROWS = [
    (1, SENTENCE, "en", "a", 1),
    (2, SENTENCE, "en", "a", 1),  # a copy
    (2, SENTENCE, "en", "a", 1),  # the same row again
    (3, SENTENCE.replace("  ", " ").upper(), "en", None, None),
    (4, SENTENCE.replace(" ", "\t\n "), None, "b", 2),
    (5, None, "en", "b", 0),
    (6, "", "en", "b", 0),
    (7, "  \n\t ", None, None, None),
    (8, "12345 !!! 678", "en", "c", 3),
    (9, "Ångström étude naïve Straße", "fr", "c", 4),
    (10, LONG, "en", "c", 5),
    (None, SENTENCE, "en", "c", 6),
    (None, None, None, None, None),
    (11, "\n".join([SENTENCE, SENTENCE.replace("lazy", "sleepy"), "short line", "short line", "", SENTENCE + " now"]), "en", "d", 7),
    (12, "<|endoftext|> <|ENDOFTEXT|> isn't it, they'll say ### x</turn>", "en", "d", 8),
]


def odd_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing_docs(spark: SparkSession) -> DataFrame:
    docs = odd_docs(spark)
    for name in CLASHING:
        docs = docs.withColumn(name, docs["source"])
    return docs


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
