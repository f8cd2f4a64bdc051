"""SQL that says independently what each registered query has to return.

Each named table below is one common table expression; ``with_tables`` puts the
ones a statement mentions in front of it.
"""

from __future__ import annotations

import re

from .. import fixed_values as fv
from .. import fixtures

GIVEN = {"orders": "orders", "customer": "customer", "events": "events"}
LOWER_COLUMNS = [c.lower() for c in fv.RAW_COLUMNS]


def to_int(c: str) -> str:
    return (
        f"try_cast(CASE WHEN regexp_full_match({c}, '\\s*[+-]?\\d+(\\.\\d*)?\\s*') "
        f"THEN regexp_extract({c}, '[+-]?\\d+') END AS INT)"
    )


def mapped(c: str, values: dict, otherwise: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items())
    return f"CASE {c} {cases} ELSE {otherwise} END"


def translated(c: str, dictionary: dict[str, str]) -> str:
    return mapped(c, {k: f"'{v}'" for k, v in dictionary.items()}, c)


def price(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '(?i)less than') THEN 15000 WHEN regexp_matches({c}, '20000 to 29000') THEN 25000 "
        f"WHEN regexp_matches({c}, '30000 to 39000') THEN 35000 WHEN regexp_matches({c}, '40000 to 59000') THEN 50000 "
        f"WHEN regexp_matches({c}, '60000 to 69000') THEN 65000 WHEN regexp_matches({c}, '(?i)more than') THEN 80000 "
        f"ELSE 30000 END"
    )


def lower_bound(c: str, scalar: bool = False) -> str:
    bare = f"WHEN regexp_matches({c}, '^\\d+$') THEN try_cast({c} AS INT) " if scalar else ""
    return (
        f"CASE WHEN regexp_matches({c}, '(?i)^none$') THEN 0 "
        f"WHEN regexp_matches({c}, '(?i)more than (\\d+)') THEN try_cast(regexp_extract({c}, 'more than (\\d+)', 1) AS INT) + 1 "
        f"WHEN regexp_matches({c}, '(\\d+) to (\\d+)') THEN try_cast(regexp_extract({c}, '(\\d+) to', 1) AS INT) {bare}END"
    )


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def alert(p: str) -> str:
    return (
        f"CASE WHEN {p} < 0 OR {p} > 1 THEN NULL WHEN {p} <= 0.2 THEN 'BAJO' WHEN {p} <= 0.4 THEN 'MEDIO' "
        f"WHEN {p} <= 0.7 THEN 'ALTO' WHEN {p} <= 1 THEN 'CRÍTICO' END"
    )


def cleaned(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\r\\n]', '', 'g'), ' ')"


AS_OF = "TIMESTAMP '2024-01-02 03:04:05'"


def _typed_columns() -> str:
    out = []
    for c in LOWER_COLUMNS:
        if c == "policytype":
            out += [
                "split_part(policytype, ' - ', 1) AS tipo_vehiculo_poliza",
                "string_split(policytype, ' - ')[2] AS cobertura",
            ]
        else:
            out.append(f"{to_int(c)} AS {c}" if c in fv.INTEGER_COLUMNS else c)
    return ", ".join(out)


def _curated_columns() -> str:
    back = {new: old for old, new in fv.CURATED_NAMES.items()}
    out = []
    for c in fv.CURATED_COLUMNS:
        raw = back.get(c, c)
        out.append(f"{translated(raw, fv.TRANSLATIONS[raw]) if raw in fv.TRANSLATIONS else raw} AS {c}")
    return ", ".join(out)


def _encoded_columns() -> str:
    return ", ".join(
        f"CAST({mapped(c, values, str(default))} AS DOUBLE) AS {name}"
        for name, (c, values, default) in fv.ORDINALS.items()
    )


def _sized_text(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"coalesce(length({text}) || ':' || {text}, '~')"


def content_hash(cols: list[str], seed: int) -> str:
    return f"md5('{seed};' || {' || '.join(_sized_text(c) for c in cols)})"


TABLES = {
    "claims": fixtures.CLAIMS_SQL.format(**GIVEN),
    "scored": fixtures.SCORED_SQL.format(**GIVEN),
    "evals": fixtures.EVALS_SQL.format(**GIVEN),
    "feedback": fixtures.FEEDBACK_SQL.format(**GIVEN),
    "forms": fixtures.FORMS_SQL.format(**GIVEN),
    "cleaned": f"SELECT {', '.join(f'{cleaned(c)} AS {c}' for c in LOWER_COLUMNS)} FROM claims",
    "gated": (
        f"SELECT * FROM cleaned WHERE policynumber IS NOT NULL AND {to_int('year')} > 1900 "
        f"AND month <> '0' AND monthclaimed <> '0' AND {to_int('age')} >= 0"
    ),
    "typed": f"SELECT {_typed_columns()} FROM gated",
    "curated": f"SELECT {_curated_columns()} FROM typed",
    "estimated": (
        f"SELECT *, {price('rango_precio_vehiculo')} AS valor_estimado_vehiculo, "
        "CASE WHEN semana_reclamo IS NOT NULL AND semana_accidente IS NOT NULL "
        "THEN greatest(semana_reclamo - semana_accidente, 0) END AS semanas_retraso_reporte, "
        f"{lower_bound('dias_poliza_accidente')} AS dias_poliza_accidente_min, "
        f"{lower_bound('reclamos_pasados', True)} AS reclamos_pasados_min FROM curated"
    ),
    "enriched": (
        f"SELECT *, {flag("zona_accidente = 'Urbano'")} AS zona_accidente_ml, "
        f"{flag("reporte_policial = 'Sí'")} AS reporte_policial_ml, "
        f"{flag("testigo_presente = 'Sí'")} AS testigo_presente_ml, "
        f"{flag("genero = 'Femenino'")} AS genero_ml, "
        "CASE WHEN testigo_presente = 'No' THEN 1 ELSE 0 END + CASE WHEN reporte_policial = 'No' THEN 1 ELSE 0 END + "
        "CASE WHEN reclamos_pasados_min > 0 THEN 1 ELSE 0 END + CASE WHEN semanas_retraso_reporte >= 2 THEN 1 ELSE 0 END + "
        "CASE WHEN dias_poliza_accidente_min <= 7 THEN 1 ELSE 0 END AS score_riesgo, "
        f"{AS_OF} AS gob_fecha_procesamiento, 'Sistema_Seguros_Oracle' AS gob_fuente_datos, "
        "'Validado_Curated' AS gob_calidad_datos, CAST(0 AS DOUBLE) AS ml_probabilidad_fraude, 0 AS ml_prediccion "
        "FROM estimated"
    ),
    "kpis": (
        "SELECT mes_reclamo, zona_accidente, tipo_vehiculo_poliza, count(*) AS total_reclamos, "
        "CAST(sum(fraude_detectado) AS BIGINT) AS total_fraudes, "
        "round(CAST(sum(fraude_detectado) AS DOUBLE) / count(*) * 100, 2) AS kpi_tasa_fraude_pct, "
        "CAST(sum(CASE WHEN fraude_detectado = 1 THEN valor_estimado_vehiculo - deducible ELSE 0 END) AS BIGINT) AS kpi_perdidas_evitadas_usd, "
        "round(avg(semanas_retraso_reporte), 1) AS kpi_semanas_prom_retraso, "
        "round(avg(score_riesgo), 2) AS kpi_score_riesgo_promedio, "
        "round(CAST(sum(fraude_detectado) * 500 AS DOUBLE) / count(*), 2) AS kpi_costo_investigacion_promedio_usd, "
        "round(CAST(sum(CASE WHEN testigo_presente = 'No' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100, 2) AS kpi_pct_sin_testigo, "
        "round(CAST(sum(CASE WHEN reporte_policial = 'No' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100, 2) AS kpi_pct_sin_reporte_policial "
        "FROM enriched WHERE mes_reclamo IS NOT NULL GROUP BY ALL"
    ),
    "encoded": f"SELECT *, {_encoded_columns()} FROM enriched",
    "flagged": (
        "SELECT *, CASE WHEN tipo_agente = 'External' THEN 1 ELSE 0 END AS agente_externo, "
        "semana_reclamo - semana_accidente AS diff_semanas_reclamo, "
        "CASE WHEN cambio_direccion_ord >= 3 THEN 1 ELSE 0 END AS flag_cambio_reciente, "
        "CASE WHEN semanas_retraso_reporte > 0 THEN 1 ELSE 0 END AS flag_reporte_tardio, "
        "CASE WHEN testigo_presente_ml = 0 AND reporte_policial_ml = 0 THEN 1 ELSE 0 END AS flag_sin_testigo_sin_policial "
        "FROM encoded"
    ),
    "featured": (
        "SELECT *, flag_cambio_reciente * 3 + flag_reporte_tardio * 2 + flag_sin_testigo_sin_policial * 2 + agente_externo * 1 "
        "+ CASE WHEN reclamos_pasados_ord = 0 THEN 1 ELSE 0 END AS score_riesgo_v2, "
        "CAST(valor_estimado_vehiculo AS DOUBLE) / (CAST(deducible AS DOUBLE) + 1) AS ratio_valor_deducible FROM flagged"
    ),
    "complete": (
        "SELECT * FROM featured WHERE fraude_detectado IS NOT NULL AND "
        + " AND ".join(f"{c} IS NOT NULL" for c in fv.NUMERIC_FEATURES + fv.CATEGORICAL_FEATURES)
    ),
    "derived_forms": (
        "SELECT * EXCLUDE (fecha_accidente, fecha_reclamo), "
        "CASE WHEN valor_estimado_vehiculo < 20000 THEN 'less than 20000' WHEN valor_estimado_vehiculo < 30000 THEN '20000 to 29000' "
        "WHEN valor_estimado_vehiculo < 40000 THEN '30000 to 39000' WHEN valor_estimado_vehiculo < 60000 THEN '40000 to 59000' "
        "WHEN valor_estimado_vehiculo < 70000 THEN '60000 to 69000' ELSE 'more than 69000' END AS rango_precio_vehiculo, "
        "CASE WHEN dias_poliza_accidente_min = 0 THEN 'none' WHEN dias_poliza_accidente_min <= 7 THEN '1 to 7' "
        "WHEN dias_poliza_accidente_min <= 15 THEN '8 to 15' WHEN dias_poliza_accidente_min <= 30 THEN '15 to 30' "
        "ELSE 'more than 30' END AS dias_poliza_accidente, "
        "CASE WHEN reclamos_pasados_min = 0 THEN 'none' WHEN reclamos_pasados_min = 1 THEN '1' "
        "WHEN reclamos_pasados_min <= 4 THEN '2 to 4' ELSE 'more than 4' END AS reclamos_pasados, "
        "CAST((day(CAST(fecha_accidente AS DATE)) + 6) // 7 AS INT) AS semana_accidente, "
        "CAST((day(CAST(fecha_reclamo AS DATE)) + 6) // 7 AS INT) AS semana_reclamo FROM forms"
    ),
    "latest_events": (
        "SELECT case_id, label, fecha_validacion, event_id FROM feedback "
        "QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY event_id DESC, fecha_validacion DESC, label DESC) = 1"
    ),
    "latest": "SELECT case_id, label, fecha_validacion FROM latest_events",
    "resolved": (
        "SELECT e.case_id, e.fecha_evaluacion, e.ml_probabilidad_fraude, e.ml_prediccion, "
        "coalesce(l.label, e.fraude_detectado) AS fraude_detectado, l.fecha_validacion "
        "FROM evals e LEFT JOIN latest l ON e.case_id = l.case_id"
    ),
    "confusion": (
        "SELECT count(*) FILTER (p < 0.7 AND y = 0) AS tn, count(*) FILTER (p >= 0.7 AND y = 0) AS fp, "
        "count(*) FILTER (p < 0.7 AND y = 1) AS fn, count(*) FILTER (p >= 0.7 AND y = 1) AS tp FROM scored"
    ),
    "per_score": "SELECT p AS umbral, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg FROM scored GROUP BY p",
    "score_sums": (
        "SELECT umbral, pos, neg, sum(pos) OVER (ORDER BY umbral DESC) AS tp, sum(neg) OVER (ORDER BY umbral DESC) AS fp, "
        "sum(pos) OVER () AS all_pos FROM per_score"
    ),
    "curve": (
        "SELECT umbral, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision, "
        "CAST(tp AS DOUBLE) / CAST(all_pos AS DOUBLE) AS recall FROM score_sums"
    ),
    "curve_f1": "SELECT *, 2 * (precision * recall) / (precision + recall + CAST('1e-9' AS DOUBLE)) AS f1 FROM curve",
    "area": (
        "SELECT CAST(sum(neg * (2 * (tp - pos) + pos)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc "
        "FROM score_sums"
    ),
    "hashed": (
        f"SELECT case_id, y, {content_hash(['case_id', 'y'], 42)} AS h, count(*) OVER (PARTITION BY y) AS n_y, "
        "count(*) OVER () AS n FROM scored"
    ),
    "ranked": "SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS rn FROM hashed",
}


def with_tables(statement: str) -> str:
    """The statement with every table it needs defined in front of it."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(TABLES[name])

    visit(statement)
    parts = [f"{name} AS ({sql})" for name, sql in TABLES.items() if name in needed]
    if statement.startswith("WITH "):
        parts.append(statement.removeprefix("WITH "))
        return "WITH " + ", ".join(parts)
    return f"WITH {', '.join(parts)} {statement}" if parts else statement
