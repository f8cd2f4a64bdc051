"""Queries over the claim table: cleaning, translation, derivation, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..fixed_values import (
    CURATED_COLUMNS,
    CURATED_NAMES,
    FEEDBACK_ONLY_COLUMNS,
    INTEGER_COLUMNS,
    LABEL,
    LANDING_PARTITION,
    LEAKY_COLUMNS,
    POLICY_PAIR,
    RAW_COLUMNS,
    TRANSLATIONS,
)
from ..functions.numbers import clamped_diff
from ..functions.text import price_midpoint, range_lower_bound
from ..operators import clean, derive, features, kpi, localize
from . import oracles as o
from .layers import fraud_hotspots
from .registry import query


def fixed_time() -> Column:
    """A processing time that results can be compared on."""
    return F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.claims(spark, sf)


def gated(spark: SparkSession, sf: str) -> DataFrame:
    return clean.quality_gate(clean.clean_strings(raw(spark, sf)))


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return localize.curate(raw(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return derive.enrich(curated(spark, sf), as_of=fixed_time())


@query("lower_columns", "SELECT * FROM claims")
def _(spark, sf):
    return clean.lower_columns(raw(spark, sf).toDF(*RAW_COLUMNS))


@query("unqualify_columns", "SELECT * FROM claims")
def _(spark, sf):
    claims = raw(spark, sf)
    return clean.unqualify_columns(claims.toDF(*[f"fraudes_enriquecido.{c}" for c in claims.columns]))


@query("partition_last", f"SELECT * EXCLUDE ({LANDING_PARTITION}), {LANDING_PARTITION} FROM claims")
def _(spark, sf):
    return clean.partition_last(raw(spark, sf), LANDING_PARTITION)


@query("clean_strings", "SELECT * FROM cleaned")
def _(spark, sf):
    return clean.clean_strings(raw(spark, sf))


@query("quality_gate", "SELECT * FROM gated")
def _(spark, sf):
    return gated(spark, sf)


@query("cast_ints", f"SELECT * REPLACE ({', '.join(f'{o.to_int(c)} AS {c}' for c in INTEGER_COLUMNS)}) FROM cleaned")
def _(spark, sf):
    return clean.cast_ints(clean.clean_strings(raw(spark, sf)), INTEGER_COLUMNS)


@query(
    "split_pair",
    "SELECT policynumber, year, split_part(policytype, ' - ', 1) AS tipo_vehiculo_poliza, "
    "string_split(policytype, ' - ')[2] AS cobertura FROM cleaned",
)
def _(spark, sf):
    rows = clean.clean_strings(raw(spark, sf)).select("policynumber", "year", "policytype")
    return clean.split_pair(rows, "policytype", " - ", POLICY_PAIR)


@query(
    "translate_values",
    "SELECT policynumber, "
    + ", ".join(f"{o.translated(c, d)} AS {c}" for c, d in TRANSLATIONS.items() if c != "cobertura")
    + " FROM cleaned",
)
def _(spark, sf):
    cols = [c for c in TRANSLATIONS if c != "cobertura"]
    return localize.translate_values(clean.clean_strings(raw(spark, sf)).select("policynumber", *cols))


@query("rename_columns", f"SELECT policytype, {', '.join(f'{a} AS {b}' for a, b in CURATED_NAMES.items())} FROM claims")
def _(spark, sf):
    return localize.rename_columns(raw(spark, sf))


@query("project", f"SELECT {', '.join(CURATED_COLUMNS)} FROM enriched")
def _(spark, sf):
    return clean.project(enriched(spark, sf), CURATED_COLUMNS)


@query("curated_claims", "SELECT * FROM curated")
def _(spark, sf):
    return curated(spark, sf)


@query("price_midpoint", f"SELECT policynumber, vehicleprice, {o.price('vehicleprice')} AS valor FROM claims")
def _(spark, sf):
    return raw(spark, sf).select("policynumber", "vehicleprice", price_midpoint(F.col("vehicleprice")).alias("valor"))


@query(
    "clamped_diff",
    "SELECT numero_poliza, CASE WHEN semana_reclamo IS NOT NULL AND semana_accidente IS NOT NULL "
    "THEN greatest(semana_reclamo - semana_accidente, 0) END AS retraso FROM curated",
)
def _(spark, sf):
    delay = clamped_diff(F.col("semana_reclamo"), F.col("semana_accidente"))
    return curated(spark, sf).select("numero_poliza", delay.alias("retraso"))


@query(
    "range_lower_bound",
    f"SELECT numero_poliza, {o.lower_bound('dias_poliza_accidente')} AS dias_min, "
    f"{o.lower_bound('dias_poliza_reclamo')} AS dias_reclamo_min FROM curated",
)
def _(spark, sf):
    return curated(spark, sf).select(
        "numero_poliza",
        range_lower_bound(F.col("dias_poliza_accidente")).alias("dias_min"),
        range_lower_bound(F.col("dias_poliza_reclamo")).alias("dias_reclamo_min"),
    )


@query(
    "range_lower_bound_scalar",
    f"SELECT numero_poliza, {o.lower_bound('reclamos_pasados', True)} AS reclamos_min FROM curated",
)
def _(spark, sf):
    bound = range_lower_bound(F.col("reclamos_pasados"), allow_scalar=True)
    return curated(spark, sf).select("numero_poliza", bound.alias("reclamos_min"))


@query(
    "binary_flags",
    "SELECT numero_poliza, zona_accidente_ml, reporte_policial_ml, testigo_presente_ml, genero_ml FROM enriched",
)
def _(spark, sf):
    return derive.binary_flags(curated(spark, sf)).select("numero_poliza", *derive.claim_flags())


@query("additive_score", "SELECT numero_poliza, score_riesgo FROM enriched")
def _(spark, sf):
    return derive.with_risk_score(derive.with_estimates(curated(spark, sf))).select("numero_poliza", "score_riesgo")


@query(
    "with_audit",
    f"SELECT numero_poliza, {o.AS_OF} AS gob_fecha_procesamiento, 'Sistema_Seguros_Oracle' AS gob_fuente_datos, "
    "'Validado_Curated' AS gob_calidad_datos FROM curated",
)
def _(spark, sf):
    return derive.with_audit(curated(spark, sf).select("numero_poliza"), as_of=fixed_time())


@query(
    "with_placeholders",
    "SELECT numero_poliza, CAST(0 AS DOUBLE) AS ml_probabilidad_fraude, 0 AS ml_prediccion FROM curated",
)
def _(spark, sf):
    return derive.with_placeholders(curated(spark, sf).select("numero_poliza"))


@query("enriched_claims", "SELECT * FROM enriched")
def _(spark, sf):
    return enriched(spark, sf)


@query("segment_kpis", "SELECT * FROM kpis")
def _(spark, sf):
    return kpi.segment_kpis(enriched(spark, sf))


@query("segment_kpis_without_month", "SELECT * FROM kpis WHERE mes_reclamo <> 'Enero'")
def _(spark, sf):
    # Claims whose month is unknown form no segment.
    unknown = enriched(spark, sf).withColumn("mes_reclamo", F.nullif("mes_reclamo", F.lit("Enero")))
    return kpi.segment_kpis(unknown)


@query(
    "top_segments",
    "SELECT mes_reclamo, zona_accidente, tipo_vehiculo_poliza, total_reclamos, total_fraudes, kpi_tasa_fraude_pct, "
    "kpi_perdidas_evitadas_usd, kpi_score_riesgo_promedio FROM kpis "
    "ORDER BY kpi_tasa_fraude_pct DESC, mes_reclamo, zona_accidente, tipo_vehiculo_poliza LIMIT 10",
)
def _(spark, sf):
    return fraud_hotspots(raw(spark, sf))


_SHOWN = [
    "numero_poliza", "mes_accidente", "dia_accidente", "mes_reclamo", "dia_reclamo", "estado_civil", "zona_accidente",
    "fraude_detectado",
]


@query("sample_rows", f"SELECT {', '.join(_SHOWN)} FROM curated ORDER BY numero_poliza LIMIT 5")
def _(spark, sf):
    return kpi.sample_rows(curated(spark, sf).select(*_SHOWN), 5, ["numero_poliza"])


@query(
    "layer_counts",
    "SELECT 'landing' AS capa, count(*) AS registros FROM claims UNION ALL SELECT 'curated', count(*) FROM curated "
    "UNION ALL SELECT 'enriched', count(*) FROM enriched UNION ALL SELECT 'kpis', count(*) FROM kpis",
)
def _(spark, sf):
    rich = enriched(spark, sf)
    return kpi.layer_counts(
        {"landing": raw(spark, sf), "curated": curated(spark, sf), "enriched": rich, "kpis": kpi.segment_kpis(rich)}
    )


_RULES = {
    "poliza_presente": "policynumber IS NOT NULL",
    "anio_valido": f"{o.to_int('year')} > 1900",
    "mes_accidente_presente": "month <> '0'",
    "mes_reclamo_presente": "monthclaimed <> '0'",
    "edad_valida": f"{o.to_int('age')} >= 0",
}


@query(
    "quality_report",
    "SELECT (SELECT count(*) FROM claims) AS total_origen, (SELECT count(*) FROM gated) AS total_curated, "
    "(SELECT count(*) FROM claims) - (SELECT count(*) FROM gated) AS descartados, "
    + ", ".join(f"count(*) FILTER (NOT coalesce({c}, false)) AS incumple_{n}" for n, c in _RULES.items())
    + " FROM cleaned",
)
def _(spark, sf):
    return kpi.quality_report(raw(spark, sf))


@query(
    "class_balance",
    "SELECT count(*) AS registros, CAST(sum(fraude_detectado) AS BIGINT) AS positivos, "
    "CAST(printf('%.1f', avg(fraude_detectado) * 100) AS DOUBLE) AS pct_positivos FROM complete",
)
def _(spark, sf):
    return kpi.class_balance(features.training_frame(enriched(spark, sf)))


_ORDINALS = ", ".join(features.ORDINALS)


@query("ordinal_encode", f"SELECT numero_poliza, {_ORDINALS} FROM encoded")
def _(spark, sf):
    return features.ordinal_encode(curated(spark, sf)).select("numero_poliza", *features.ORDINALS)


@query(
    "risk_features",
    f"SELECT numero_poliza, {_ORDINALS}, agente_externo, diff_semanas_reclamo, flag_cambio_reciente, flag_reporte_tardio, "
    "flag_sin_testigo_sin_policial, ratio_valor_deducible FROM featured",
)
def _(spark, sf):
    return features.risk_features(enriched(spark, sf)).select(
        "numero_poliza", *features.ORDINALS, "agente_externo", "diff_semanas_reclamo", "flag_cambio_reciente",
        "flag_reporte_tardio", "flag_sin_testigo_sin_policial", "ratio_valor_deducible",
    )


@query("weighted_score", "SELECT numero_poliza, CAST(score_riesgo_v2 AS INT) AS score_riesgo_v2 FROM featured")
def _(spark, sf):
    return features.risk_features(enriched(spark, sf)).select("numero_poliza", "score_riesgo_v2")


@query("feature_columns", f"SELECT {', '.join(features.NUMERIC_FEATURES + features.CATEGORICAL_FEATURES)} FROM featured")
def _(spark, sf):
    return features.feature_columns(features.risk_features(enriched(spark, sf)))


@query("drop_if_present", f"SELECT * EXCLUDE (ml_prediccion, ml_probabilidad_fraude) FROM enriched")
def _(spark, sf):
    return clean.drop_if_present(enriched(spark, sf), FEEDBACK_ONLY_COLUMNS)


@query("without_leaky", f"SELECT * EXCLUDE ({', '.join(LEAKY_COLUMNS)}) FROM enriched")
def _(spark, sf):
    return features.without_leaky(enriched(spark, sf))


@query("complete_cases", "SELECT * FROM enriched WHERE cobertura IS NOT NULL AND dias_poliza_accidente_min IS NOT NULL")
def _(spark, sf):
    return clean.complete_cases(enriched(spark, sf), ["cobertura", "dias_poliza_accidente_min"])


@query(
    "training_frame",
    f"SELECT {', '.join(features.NUMERIC_FEATURES + features.CATEGORICAL_FEATURES)}, {LABEL} FROM complete",
)
def _(spark, sf):
    return features.training_frame(enriched(spark, sf))
