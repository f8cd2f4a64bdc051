"""Cleaning, quality rules, typing and projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..functions.text import lenient_int, split_part, strip_breaks


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def unqualify_columns(df: DataFrame) -> DataFrame:
    """Strip ``table.`` prefixes from column names."""
    return df.toDF(*[c.rsplit(".", 1)[-1] for c in df.columns])


def partition_last(df: DataFrame, key: str) -> DataFrame:
    """Move the partition column to the end."""
    return df.select(*[c for c in df.columns if c != key], key)


def clean_strings(df: DataFrame) -> DataFrame:
    """Delete line breaks and outer spaces in every text column."""
    return df.select(
        *[
            strip_breaks(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else f.name
            for f in df.schema.fields
        ]
    )


def claim_rules() -> dict[str, Column]:
    """Named conditions a cleaned raw claim has to meet."""
    return {
        "poliza_presente": F.col("policynumber").isNotNull(),
        "anio_valido": lenient_int(F.col("year")) > 1900,
        "mes_accidente_presente": F.col("month") != "0",
        "mes_reclamo_presente": F.col("monthclaimed") != "0",
        "edad_valida": lenient_int(F.col("age")) >= 0,
    }


def quality_gate(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Keep rows that meet every rule; an unknown outcome fails."""
    for condition in (rules or claim_rules()).values():
        df = df.filter(condition)
    return df


def cast_ints(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text to int in place; bad text becomes null."""
    return df.withColumns({c: lenient_int(F.col(c)) for c in cols})


def split_pair(df: DataFrame, col: str, separator: str, names: tuple[str, str]) -> DataFrame:
    """Split one column into two, a missing part null, and drop the source."""
    pieces = {name: split_part(F.col(col), separator, i) for i, name in enumerate(names)}
    return df.withColumns(pieces).drop(col)


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed columns in fixed order."""
    return df.select(*cols)


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*cols)


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a null, or a NaN, in any of the columns.

    One plain condition per column, so each can reach the scan.
    """
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            df = df.filter(~F.isnan(c))
    return df
