"""Model features, serving-side bands and explanations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    CATEGORICAL_FEATURES,
    CLAIM_BANDS,
    CLAIM_EXACT,
    DAY_BANDS,
    DAY_EXACT,
    FEEDBACK_ONLY_COLUMNS,
    LABEL,
    LEAKY_COLUMNS,
    NUMERIC_FEATURES,
    ORDINALS,
    PRICE_BANDS,
    RISK_WEIGHTS,
    SIGNAL_TEXTS,
)
from ..functions.numbers import bucket_label, flag, weighted_score
from ..functions.text import ordinal, week_of_month
from .clean import complete_cases, drop_if_present


def ordinal_encode(df: DataFrame, encodings: dict | None = None) -> DataFrame:
    """Risk ranks of band text, with a default for unknown or null."""
    return df.withColumns(
        {name: ordinal(F.col(c), values, default) for name, (c, values, default) in (encodings or ORDINALS).items()}
    )


def risk_features(df: DataFrame) -> DataFrame:
    """Everything the model needs beyond the enriched columns."""
    encoded = ordinal_encode(df).withColumns(
        {
            "agente_externo": flag(F.col("tipo_agente") == "External"),
            "diff_semanas_reclamo": F.col("semana_reclamo") - F.col("semana_accidente"),
            "flag_reporte_tardio": flag(F.col("semanas_retraso_reporte") > 0),
            "flag_sin_testigo_sin_policial": flag(
                (F.col("testigo_presente_ml") == 0) & (F.col("reporte_policial_ml") == 0)
            ),
            # A deductible of -1 has no ratio: null, so training leaves the row out.
            "ratio_valor_deducible": F.try_divide(
                F.col("valor_estimado_vehiculo").cast("double"), F.col("deducible").cast("double") + 1
            ),
        }
    )
    flagged = encoded.withColumn("flag_cambio_reciente", flag(F.col("cambio_direccion_ord") >= 3))
    no_history = flag(F.col("reclamos_pasados_ord") == 0)
    return flagged.withColumn("score_riesgo_v2", weighted_score(RISK_WEIGHTS) + no_history)


def assert_no_leakage(cols: Iterable[str]) -> list[str]:
    """Reject feature lists that hold a label, id, prediction or audit column."""
    cols = list(cols)
    leaked = sorted(set(cols) & set(LEAKY_COLUMNS))
    if leaked:
        raise ValueError(f"not allowed as model inputs: {', '.join(leaked)}")
    return cols


def without_leaky(df: DataFrame) -> DataFrame:
    """Drop every column that must not reach a model."""
    return drop_if_present(df, LEAKY_COLUMNS)


def feature_columns(df: DataFrame) -> DataFrame:
    """The 24 numeric and 4 categorical model inputs."""
    return df.select(*assert_no_leakage(NUMERIC_FEATURES + CATEGORICAL_FEATURES))


def training_frame(enriched: DataFrame, ids: Iterable[str] = ()) -> DataFrame:
    """Complete rows of features plus an int label, and the ``ids`` that tell rows apart."""
    cols = assert_no_leakage(NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    # Ranks have a default and are never missing.
    rows = complete_cases(risk_features(enriched), [LABEL, *[c for c in cols if c not in ORDINALS]])
    return rows.select(*ids, *cols, F.col(LABEL).cast("int").alias(LABEL))


def with_feedback(history: DataFrame, feedback: DataFrame) -> DataFrame:
    """History plus validated feedback by column name, missing ones null."""
    return history.unionByName(drop_if_present(feedback, FEEDBACK_ONLY_COLUMNS), allowMissingColumns=True)


def form_fields(df: DataFrame) -> DataFrame:
    """Bands and weeks of a scoring form's plain numbers and dates.

    Weeks count within the month, as in the claims a model is trained on.
    """
    return df.withColumns(
        {
            "rango_precio_vehiculo": bucket_label(F.col("valor_estimado_vehiculo"), PRICE_BANDS, closed=False),
            "dias_poliza_accidente": bucket_label(F.col("dias_poliza_accidente_min"), DAY_BANDS, closed=True, exact=DAY_EXACT),
            "reclamos_pasados": bucket_label(F.col("reclamos_pasados_min"), CLAIM_BANDS, closed=True, exact=CLAIM_EXACT),
            "semana_accidente": week_of_month(F.col("fecha_accidente")),
            "semana_reclamo": week_of_month(F.col("fecha_reclamo")),
        }
    ).drop("fecha_accidente", "fecha_reclamo")


def explain_signals(df: DataFrame) -> DataFrame:
    """Five named yes/no signals, and the display texts of those that hold."""
    signals = {
        "cambio_reciente": F.col("cambio_direccion").isin("under 6 months", "2 to 3 years"),
        "sin_testigo_ni_reporte": (F.col("testigo_presente_ml") == 0) & (F.col("reporte_policial_ml") == 0),
        "retraso_reporte": F.col("semanas_retraso_reporte") > 0,
        "accidente_temprano": F.col("dias_poliza_accidente_min") <= 15,
        "agente_externo": F.col("tipo_agente") == "External",
    }
    named = {f"senal_{name}": F.coalesce(c, F.lit(False)) for name, c in signals.items()}
    texts = [F.when(F.col(f"senal_{name}"), F.lit(SIGNAL_TEXTS[name])) for name in signals]
    return df.withColumns(named).withColumn("senales", F.array_compact(F.array(*texts)))
