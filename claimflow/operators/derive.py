"""Numeric estimates, flags, risk score and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import QUALITY_TAG, SOURCE_NAME
from ..functions.numbers import additive_score, clamped_diff, flag
from ..functions.text import price_midpoint, range_lower_bound


def with_estimates(df: DataFrame) -> DataFrame:
    """Numbers read out of band text, and the reporting delay in weeks."""
    return df.withColumns(
        {
            "valor_estimado_vehiculo": price_midpoint(F.col("rango_precio_vehiculo")),
            "semanas_retraso_reporte": clamped_diff(F.col("semana_reclamo"), F.col("semana_accidente")),
            "dias_poliza_accidente_min": range_lower_bound(F.col("dias_poliza_accidente")),
            "reclamos_pasados_min": range_lower_bound(F.col("reclamos_pasados"), allow_scalar=True),
        }
    )


def claim_flags() -> dict[str, tuple[str, str]]:
    """Flag name -> (source column, value that sets it)."""
    return {
        "zona_accidente_ml": ("zona_accidente", "Urbano"),
        "reporte_policial_ml": ("reporte_policial", "Sí"),
        "testigo_presente_ml": ("testigo_presente", "Sí"),
        "genero_ml": ("genero", "Femenino"),
    }


def binary_flags(df: DataFrame, spec: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """0/1 columns; null sources give 0."""
    return df.withColumns({name: flag(F.col(c) == v) for name, (c, v) in (spec or claim_flags()).items()})


def risk_signals() -> list[Column]:
    """The five signals of the heuristic score."""
    return [
        F.col("testigo_presente") == "No",
        F.col("reporte_policial") == "No",
        F.col("reclamos_pasados_min") > 0,
        F.col("semanas_retraso_reporte") >= 2,
        F.col("dias_poliza_accidente_min") <= 7,
    ]


def with_risk_score(df: DataFrame) -> DataFrame:
    """Heuristic score 0-5."""
    return df.withColumn("score_riesgo", additive_score(risk_signals()))


def with_audit(
    df: DataFrame, source: str = SOURCE_NAME, tag: str = QUALITY_TAG, as_of: Column | None = None
) -> DataFrame:
    """Processing time, source name and quality tag."""
    return df.withColumns(
        {
            "gob_fecha_procesamiento": F.current_timestamp() if as_of is None else as_of,
            "gob_fuente_datos": F.lit(source),
            "gob_calidad_datos": F.lit(tag),
        }
    )


def with_placeholders(df: DataFrame) -> DataFrame:
    """Model columns before any model has run."""
    return df.withColumns({"ml_probabilidad_fraude": F.lit(0.0), "ml_prediccion": F.lit(0)})


def enrich(curated: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Curated claims -> enriched claims (48 columns), one narrow stage."""
    scored = with_risk_score(binary_flags(with_estimates(curated)))
    return with_placeholders(with_audit(scored, as_of=as_of))
