"""Cleaning, gating, translation and KPIs on derived claims."""

import pytest
from pyspark.sql import functions as F

from claimflow import fixtures
from claimflow.fixed_values import CURATED_COLUMNS
from claimflow.operators import clean, derive, kpi, localize
from claimflow.sources.schemas import CURATED_SCHEMA


@pytest.fixture(scope="module")
def claims(spark, sf):
    return fixtures.claims(spark, sf).cache()


def test_fixture_equals_its_sql(spark, sf, claims):
    o, c = (fixtures.table(spark, sf, t) for t in ("orders", "customer"))
    by_sql = spark.sql(fixtures.CLAIMS_SQL, orders=o, customer=c)
    assert claims.exceptAll(by_sql).isEmpty() and by_sql.exceptAll(claims).isEmpty()


def test_curated_shape(claims):
    out = localize.curate(claims)
    assert out.columns == CURATED_COLUMNS and len(out.columns) == 34
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CURATED_SCHEMA.fields]
    assert len(derive.enrich(out).columns) == 48


def test_gate_and_report_agree(claims):
    r = kpi.quality_report(claims).first()
    assert r.total_origen == claims.count() == 1500
    assert r.total_curated == localize.curate(claims).count()
    assert r.total_curated + r.descartados == r.total_origen
    assert (r.incumple_mes_accidente_presente, r.incumple_mes_reclamo_presente) == (3, claims.filter("monthclaimed = '0' OR monthclaimed IS NULL").count())


def test_accents_survive(claims):
    values = {r[0] for r in localize.curate(claims).select("reporte_policial").distinct().collect()}
    assert values == {"Sí", "No"}


def test_unknown_values_and_nulls_pass(spark):
    df = spark.createDataFrame([("Xyz", None)], "month string, sex string")
    assert tuple(localize.translate_values(df).first()) == ("Xyz", None)


def test_gate_drops_unknown_outcomes(spark):
    rows = [
        ("1", "1994", "Jan", "Feb", "30"), (None, "1994", "Jan", "Feb", "30"), ("2", "1900", "Jan", "Feb", "30"),
        ("3", "abc", "Jan", "Feb", "30"), ("4", "1994", "0", "Feb", "30"), ("5", "1994", "Jan", None, "30"),
        ("6", "1994", "Jan", "Feb", "-1"), ("7", "1994", "Jan", "Feb", None), ("8", "1994", None, "Feb", "30"),
        ("9", "1994.5", "Jan", "Feb", "0"),
    ]
    df = spark.createDataFrame(rows, "policynumber string, year string, month string, monthclaimed string, age string")
    assert [r.policynumber for r in clean.quality_gate(df).orderBy("policynumber").collect()] == ["1", "9"]


def test_kpis_by_hand(spark):
    cols = (
        "mes_reclamo string, zona_accidente string, tipo_vehiculo_poliza string, fraude_detectado int, valor_estimado_vehiculo int, "
        "deducible int, semanas_retraso_reporte int, score_riesgo int, testigo_presente string, reporte_policial string"
    )
    rows = [
        ("Enero", "Urbano", "Sedan", 1, 25000, 400, 2, 3, "No", "No"),
        ("Enero", "Urbano", "Sedan", 0, 25000, 400, None, 1, "Sí", "No"),
        ("Enero", "Urbano", "Sedan", 1, 15000, None, 1, 2, "No", None),
        (None, "Urbano", "Sedan", 1, 15000, 300, 1, 2, "No", "No"),
    ]
    out = kpi.segment_kpis(spark.createDataFrame(rows, cols)).collect()
    assert len(out) == 1
    assert tuple(out[0])[3:] == (3, 2, 66.67, 24600, 1.5, 2.0, 333.33, 66.67, 66.67)


def test_top_segments_break_ties_by_key(claims):
    kpis = kpi.segment_kpis(derive.enrich(localize.curate(claims)))
    top = [tuple(r) for r in kpi.top_segments(kpis, 10).collect()]
    want = sorted((tuple(r) for r in kpi.top_segments(kpis, 10_000).collect()), key=lambda r: (-r[5], r[0], r[1], r[2]))
    assert top == want[:10]


def test_names_are_lowered_and_unqualified(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert clean.lower_columns(df).columns == ["a", "b"]
    assert clean.unqualify_columns(df.toDF("t.a", "b")).columns == ["a", "b"]
    assert clean.partition_last(df, "A").columns == ["b", "A"]
    assert clean.drop_if_present(df, ["b", "absent"]).columns == ["A"]


def test_complete_cases_drops_nan_too(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (float("nan"), "x"), (1.0, None)], "a double, b string")
    assert clean.complete_cases(df, ["a"]).count() == 2


def test_sample_is_ordered(claims):
    got = [r.policynumber for r in kpi.sample_rows(claims.filter("policynumber IS NOT NULL"), 3, ["policynumber"]).collect()]
    assert got == sorted(r.policynumber for r in claims.filter("policynumber IS NOT NULL").collect())[:3]
