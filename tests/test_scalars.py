"""Unit rows of every scalar operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.fixed_values import CLAIM_BANDS, CLAIM_EXACT, DAY_BANDS, DAY_EXACT, PRICE_BANDS, MONTHS, ORDINALS
from claimflow.functions import numbers, text
from claimflow.operators import derive, features


def each(spark, values, kind, expression):
    """The expression's value on each input, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}").repartition(3)
    return [r.out for r in df.select("i", expression(F.col("c")).alias("out")).orderBy("i").collect()]


CASES = [
    ("string", text.strip_breaks, {"  a\r\nb ": "ab", "\ta ": "\ta", "": "", None: None, "a\nb\r": "ab", "plain": "plain"}),
    ("string", text.lenient_int, {" 7 ": 7, "": None, "abc": None, "-1": -1, "1994.5": 1994, "7.": 7, "1e3": None,
                                  "99999999999": None, "+4": 4, None: None}),
    ("string", lambda c: text.split_part(c, " - ", 0), {"Sedan - All Perils": "Sedan", "Sedan": "Sedan", "A - - B": "A",
                                                        " - x": "", None: None}),
    ("string", lambda c: text.split_part(c, " - ", 1), {"Sedan - All Perils": "All Perils", "Sedan": None,
                                                        "A - B - C": "B", "A - - B": "- B", "A - ": "", None: None}),
    ("string", lambda c: text.split_part(c, " - ", 2), {"A - B - C": "C", "A - B": None}),
    ("string", lambda c: text.translate_value(c, MONTHS), {"Jan": "Enero", "Xyz": "Xyz", None: None, "": ""}),
    ("string", text.price_midpoint, {"Less Than 20000": 15000, "20000 to 29000": 25000, "more than 69000": 80000,
                                     "MORE THAN 1": 80000, "other": 30000, None: 30000,
                                     "60000 to 69000": 65000, "less than 20000 to 29000": 15000}),
    ("string", text.range_lower_bound, {"none": 0, "NONE": 0, "more than 30": 31, "More than 30": None, "8 to 15": 8,
                                        "1": None, "x": None, None: None, "more than 2147483647": None}),
    ("string", lambda c: text.range_lower_bound(c, True), {"none": 0, "1": 1, "2 to 4": 2, "more than 4": 5, "x": None,
                                                           "99999999999": None}),
    ("string", text.iso_week, {"2021-01-01": 53, "2020-12-31": 53, "2024-12-30": 1, "2024-1-9": 2, "no date": None, "2024-02-30": None, None: None}),
    ("string", lambda c: text.ordinal(c, ORDINALS["cambio_direccion_ord"][1], 0), {"under 6 months": 4.0, "?": 0.0, None: 0.0}),
    ("string", lambda c: text.ordinal(c, ORDINALS["antiguedad_vehiculo_ord"][1], 4), {"new": 0.0, "?": 4.0, None: 4.0}),
    ("double", lambda c: numbers.bucket_label(c, PRICE_BANDS, closed=False),
     {19999.0: "less than 20000", 20000.0: "20000 to 29000", 69999.0: "60000 to 69000", 70000.0: "more than 69000", None: None}),
    ("int", lambda c: numbers.bucket_label(c, DAY_BANDS, closed=True, exact=DAY_EXACT),
     {0: "none", 7: "1 to 7", 8: "8 to 15", 15: "8 to 15", 16: "15 to 30", 30: "15 to 30", 31: "more than 30", -1: "1 to 7"}),
    ("int", lambda c: numbers.bucket_label(c, CLAIM_BANDS, closed=True, exact=CLAIM_EXACT),
     {0: "none", 1: "1", 2: "2 to 4", 4: "2 to 4", 5: "more than 4"}),
    ("double", numbers.alert_level, {0.0: "BAJO", 0.2: "BAJO", 0.4: "MEDIO", 0.7: "ALTO", 0.70001: "CRÍTICO",
                                     1.0: "CRÍTICO", 1.5: None, -0.1: None, math.nan: None, None: None}),
]


@pytest.mark.parametrize("kind, expression, rows", CASES)
def test_unit_rows(spark, kind, expression, rows):
    assert each(spark, list(rows), kind, expression) == list(rows.values())


def test_clamped_diff(spark):
    df = spark.createDataFrame([(2, 4), (4, 2), (None, 2), (2, None)], "a int, b int")
    out = df.select(numbers.clamped_diff(F.col("b"), F.col("a")).alias("d")).collect()
    assert [r.d for r in out] == [2, 0, None, None]


def test_rounding_matches_python(spark):
    values = [12.35, 12.25, 0.05, 2.675, 99.95, 0.0, 100.0] + [a / b * 100 for b in range(1, 40) for a in range(b)]
    assert each(spark, values, "double", lambda c: numbers.fixed_text(c, 1)) == ["%.1f" % v for v in values]
    for digits in (1, 2, 3):
        assert each(spark, values, "double", lambda c: numbers.round_exact(c, digits)) == [round(v, digits) for v in values]


def test_scaled_rounding_matches_numpy(spark):
    values = [0.00005, 0.00015, 0.00025, 0.12345, 0.5, 1 / 3, 0.99995]
    assert each(spark, values, "double", lambda c: numbers.round_scaled_even(c, 4)) == list(np.round(values, 4))


SIGNALS = (
    "testigo_presente string, reporte_policial string, reclamos_pasados_min int, semanas_retraso_reporte int, "
    "dias_poliza_accidente_min int"
)


@pytest.mark.parametrize(
    "row, want",
    [
        (("No", "No", 1, 2, 7), 5), ((None,) * 5, 0), (("Sí", "Sí", 0, 1, 0), 1), (("Sí", "Sí", 0, 1, 8), 0),
        (("Sí", "No", 5, 0, None), 2),
    ],
)
def test_risk_score(spark, row, want):
    assert derive.with_risk_score(spark.createDataFrame([row], SIGNALS)).first().score_riesgo == want


def test_flags_of_null_are_zero(spark):
    df = spark.createDataFrame([(None, None, None, None)], "zona_accidente string, reporte_policial string, testigo_presente string, genero string")
    assert set(derive.binary_flags(df).select(*derive.claim_flags()).first()) == {0}


def test_risk_features_edges(spark):
    cols = (
        "cambio_direccion string, antiguedad_vehiculo string, edad_titular string, dias_poliza_accidente string, "
        "reclamos_pasados string, numero_suplementos string, tipo_agente string, semana_reclamo int, semana_accidente int, "
        "semanas_retraso_reporte int, testigo_presente_ml int, reporte_policial_ml int, valor_estimado_vehiculo int, deducible int"
    )
    rows = [
        ("under 6 months", None, None, None, "none", None, "External", 1, 3, None, 0, 0, 50000, 499),
        ("no change", "new", "over 65", "none", "1", "none", "Internal", None, 3, 1, 1, 0, 50000, -1),
        ("2 to 3 years", "new", "over 65", "none", "none", "none", None, 4, 3, 2, 0, 0, 80000, 2147483647),
    ]
    out = features.risk_features(spark.createDataFrame(rows, cols)).collect()
    assert [r.diff_semanas_reclamo for r in out] == [-2, None, 1]
    assert [r.flag_reporte_tardio for r in out] == [0, 1, 1]
    assert [r.flag_cambio_reciente for r in out] == [1, 0, 1]
    assert [r.flag_sin_testigo_sin_policial for r in out] == [1, 0, 1]
    assert [r.score_riesgo_v2 for r in out] == [7, 2, 8]
    assert [r.ratio_valor_deducible for r in out] == [100.0, None, 80000 / 2147483648]


def test_leaky_inputs_are_refused():
    with pytest.raises(ValueError, match="score_riesgo"):
        features.assert_no_leakage(["edad", "score_riesgo"])


def test_explain_signals(spark):
    df = spark.createDataFrame(
        [("2 to 3 years", 0, 0, 0, 15, "External"), ("1 year", 1, 0, 1, 16, None)],
        "cambio_direccion string, testigo_presente_ml int, reporte_policial_ml int, semanas_retraso_reporte int, "
        "dias_poliza_accidente_min int, tipo_agente string",
    )
    out = [r.senales for r in features.explain_signals(df).collect()]
    assert out[0] == ["Cambio de dirección reciente", "Sin testigo ni reporte policial", "Accidente temprano en póliza", "Agente externo"]
    assert out[1] == ["Retraso en reporte"]
