"""Segment KPIs and table reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import CURATED_PARTITION, INVESTIGATION_COST, LABEL, SEGMENT_KEYS
from ..functions.numbers import flag, round_exact
from .clean import claim_rules, clean_strings


def segment_partials(enriched: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts and sums per (claim month, zone, vehicle type), which further rows' can be added to.

    One hash aggregate: tasks combine their rows per segment first, so the
    shuffle carries at most (tasks x segments) rows however hot a segment is.
    Claims without a month are left out before aggregating.
    """
    keys = keys or SEGMENT_KEYS
    saved = F.when(F.col(LABEL) == 1, F.col("valor_estimado_vehiculo") - F.col("deducible")).otherwise(0)
    # The filter belongs to the month alone, whatever else a segment is made of.
    dated = enriched.filter(F.col(CURATED_PARTITION).isNotNull()) if CURATED_PARTITION in keys else enriched
    return dated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reclamos"),
        F.sum(LABEL).alias("fraudes"),
        F.sum(saved).alias("perdidas_evitadas"),
        F.sum("semanas_retraso_reporte").alias("semanas_suma"),
        F.count("semanas_retraso_reporte").alias("semanas_n"),
        F.sum("score_riesgo").alias("score_suma"),
        F.count("score_riesgo").alias("score_n"),
        F.sum(flag(F.col("testigo_presente") == "No")).alias("sin_testigo"),
        F.sum(flag(F.col("reporte_policial") == "No")).alias("sin_reporte_policial"),
    )


def merge_partials(partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Partials of several sets of rows, added up per segment."""
    keys = keys or SEGMENT_KEYS
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in partials.columns if c not in keys])


def kpis_of_partials(partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """KPIs of segments from their counts and sums."""
    claims, frauds = F.col("reclamos"), F.col("fraudes")
    return partials.select(
        *(keys or SEGMENT_KEYS),
        claims.alias("total_reclamos"),
        frauds.alias("total_fraudes"),
        F.round(frauds / claims * 100, 2).alias("kpi_tasa_fraude_pct"),
        F.col("perdidas_evitadas").alias("kpi_perdidas_evitadas_usd"),
        F.round(F.try_divide(F.col("semanas_suma"), F.col("semanas_n")), 1).alias("kpi_semanas_prom_retraso"),
        F.round(F.try_divide(F.col("score_suma"), F.col("score_n")), 2).alias("kpi_score_riesgo_promedio"),
        F.round(frauds * INVESTIGATION_COST / claims, 2).alias("kpi_costo_investigacion_promedio_usd"),
        F.round(F.col("sin_testigo") / claims * 100, 2).alias("kpi_pct_sin_testigo"),
        F.round(F.col("sin_reporte_policial") / claims * 100, 2).alias("kpi_pct_sin_reporte_policial"),
    )


def segment_kpis(enriched: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """KPIs per (claim month, zone, vehicle type), by the one aggregate of ``segment_partials``."""
    return kpis_of_partials(segment_partials(enriched, keys), keys)


def top_segments(kpis: DataFrame, n: int = 10, keys: list[str] | None = None) -> DataFrame:
    """The n segments with the highest fraud rate; ties by segment keys."""
    keys = keys or SEGMENT_KEYS
    return (
        kpis.select(
            *keys, "total_reclamos", "total_fraudes", "kpi_tasa_fraude_pct",
            "kpi_perdidas_evitadas_usd", "kpi_score_riesgo_promedio",
        )
        .orderBy(F.desc("kpi_tasa_fraude_pct"), *keys)
        .limit(n)
    )


def sample_rows(df: DataFrame, n: int = 5, keys: list[str] | None = None) -> DataFrame:
    """n rows to look at; the first by ``keys`` where given."""
    return (df.orderBy(*keys) if keys else df).limit(n)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("capa"), "registros")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _quality(rules: dict[str, Column] | None) -> list[Column]:
    met = {name: F.coalesce(c, F.lit(False)) for name, c in (rules or claim_rules()).items()}
    kept = reduce(lambda a, b: a & b, met.values())
    return [
        F.count(F.lit(1)).alias("total_origen"),
        F.count_if(kept).alias("total_curated"),
        F.count_if(~kept).alias("descartados"),
        *[F.count_if(~c).alias(f"incumple_{name}") for name, c in met.items()],
    ]


def quality_report(landing: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows in, kept and discarded, and how many rows break each rule."""
    return clean_strings(landing).agg(*_quality(rules))


def observe_quality(cleaned: DataFrame, seen: Observation, rules: dict[str, Column] | None = None) -> DataFrame:
    """Cleaned rows, on which whatever runs over them counts the quality report."""
    return cleaned.observe(seen, *_quality(rules))


def quality_row(spark: SparkSession, seen: Observation, rules: dict[str, Column] | None = None) -> DataFrame:
    """The observed quality report as one row; no table is read for it."""
    names = ["total_origen", "total_curated", "descartados", *[f"incumple_{name}" for name in rules or claim_rules()]]
    return spark.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} long" for n in names))


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, positives and their share in % to one decimal."""
    return df.agg(
        F.count(label).alias("registros"),
        F.coalesce(F.sum(label), F.lit(0)).alias("positivos"),
        round_exact(F.avg(label) * 100, 1).alias("pct_positivos"),
    )
