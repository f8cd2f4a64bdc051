"""Value translation, renaming and the curated claim table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CURATED_COLUMNS, CURATED_NAMES, INTEGER_COLUMNS, POLICY_PAIR, TRANSLATIONS
from ..functions.text import translate_value
from .clean import cast_ints, complete_cases, clean_strings, project, quality_gate, split_pair


def translate_values(df: DataFrame, dictionaries: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Translate values column by column; unknown values and nulls stay."""
    dictionaries = dictionaries or TRANSLATIONS
    return df.withColumns({c: translate_value(F.col(c), d) for c, d in dictionaries.items() if c in df.columns})


def rename_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Rename by dictionary; absent names are ignored."""
    return df.withColumnsRenamed(names or CURATED_NAMES)


def curate(landing: DataFrame, check: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Landing claims -> cleaned, gated, typed and translated claims (34 columns).

    ``check`` sees the cleaned rows before any is left out, to count them as they pass.
    """
    if check is None:
        # Cleaning keeps nulls null, so rows that lack a checked column are left out
        # by the scan already, and the partition without a claim month is not read.
        landing = complete_cases(landing, ["policynumber", "year", "month", "monthclaimed", "age"])
    cleaned = clean_strings(landing)
    kept = quality_gate(check(cleaned) if check else cleaned)
    typed = split_pair(cast_ints(kept, INTEGER_COLUMNS), "policytype", " - ", POLICY_PAIR)
    return project(rename_columns(translate_values(typed)), CURATED_COLUMNS)
