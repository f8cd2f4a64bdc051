"""Test inputs derived from the given tables.

There is no claims table among the given data, so claims come from orders and
customers by one SQL text that Spark and DuckDB both run unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Values the derived claims take.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
PRICES = [
    "less than 20000", "20000 to 29000", "30000 to 39000", "40000 to 59000", "60000 to 69000", "more than 69000",
]
DAY_RANGES = ["none", "1 to 7", "8 to 15", "15 to 30", "more than 30"]
HOLDER_AGES = [
    "16 to 17", "18 to 20", "21 to 25", "26 to 30", "31 to 35", "36 to 40", "41 to 50", "51 to 65", "over 65",
]
ADDRESS_CHANGES = ["no change", "4 to 8 years", "1 year", "2 to 3 years", "under 6 months"]

CLAIMS_SQL = """
WITH b AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS c, o.o_totalprice AS tp, o.o_orderpriority AS pr, c.c_mktsegment AS seg,
         year(o.o_orderdate) AS yy, month(o.o_orderdate) AS mm,
         CAST(floor((day(o.o_orderdate) - 1) / 7.0) AS INT) AS w0,
         (o.o_orderkey * 7919 + o.o_custkey * 31) % 1009 AS h1,
         (o.o_orderkey * 104729 + o.o_custkey * 17) % 1013 AS h2,
         (o.o_orderkey * 1299709 + o.o_custkey * 7) % 1019 AS h3,
         (o.o_orderkey * 15485863 + o.o_custkey * 3) % 1021 AS h4
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)
SELECT
 CASE WHEN k % 503 = 0 THEN '0' ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', mm * 3 - 2, 3) END AS month,
 CAST(w0 + 1 AS STRING) AS weekofmonth,
 CASE h1 % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS dayofweek,
 CASE h2 % 5 WHEN 0 THEN 'Honda' WHEN 1 THEN 'Toyota' WHEN 2 THEN 'Ford' WHEN 3 THEN 'Mazda' ELSE 'Pontiac' END AS make,
 CASE WHEN k % 97 = 0 THEN '  Urban ' || chr(13) WHEN h3 % 10 = 0 THEN 'Rural' ELSE 'Urban' END AS accidentarea,
 CASE h2 % 5 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' ELSE 'Friday' END AS dayofweekclaimed,
 CASE WHEN k % 499 = 0 THEN '0' WHEN k % 617 = 0 THEN NULL ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', ((mm - 1 + h1 % 2) % 12) * 3 + 1, 3) END AS monthclaimed,
 CAST((w0 + h2 % 4) % 5 + 1 AS STRING) AS weekofmonthclaimed,
 CASE WHEN h3 % 6 = 0 THEN 'Female' ELSE 'Male' END AS sex,
 CASE h4 % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Widow' ELSE 'Divorced' END AS maritalstatus,
 CASE WHEN k % 701 = 0 THEN '-1' WHEN k % 709 = 0 THEN 'NA' ELSE CAST(16 + h1 % 60 AS STRING) END AS age,
 CASE WHEN h2 % 4 = 0 THEN 'Third Party' ELSE 'Policy Holder' END AS fault,
 CASE WHEN k % 211 = 0 THEN 'Sedan' ELSE CASE h3 % 3 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'Sport' ELSE 'Utility' END || ' - ' || CASE h4 % 3 WHEN 0 THEN 'Liability' WHEN 1 THEN 'Collision' ELSE 'All Perils' END END AS policytype,
 CASE h3 % 3 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'Sport' ELSE 'Utility' END AS vehiclecategory,
 CASE WHEN k % 311 = 0 THEN NULL WHEN tp < 80000 THEN 'less than 20000' WHEN tp < 160000 THEN '20000 to 29000' WHEN tp < 240000 THEN '30000 to 39000' WHEN tp < 320000 THEN '40000 to 59000' WHEN tp < 400000 THEN '60000 to 69000' ELSE 'more than 69000' END AS vehicleprice,
 CASE WHEN h4 % 100 < 4 + CASE WHEN h2 % 9 >= 7 THEN 30 ELSE 0 END + CASE WHEN h3 % 3 = 2 THEN 8 ELSE 0 END THEN '1' ELSE '0' END AS fraudfound_p,
 CASE WHEN k % 601 = 0 THEN NULL ELSE CAST(k + 1 AS STRING) END AS policynumber,
 CAST(h1 % 16 + 1 AS STRING) AS repnumber,
 CASE h2 % 4 WHEN 0 THEN '300' WHEN 1 THEN '500' ELSE CASE WHEN h3 % 2 = 0 THEN '400' ELSE '700' END END AS deductible,
 CAST(h4 % 4 + 1 AS STRING) AS driverrating,
 CASE WHEN k % 401 = 0 THEN 'More than 30' ELSE CASE h1 % 12 WHEN 0 THEN 'none' WHEN 1 THEN '1 to 7' WHEN 2 THEN '8 to 15' WHEN 3 THEN '15 to 30' ELSE 'more than 30' END END AS days_policy_accident,
 CASE h2 % 8 WHEN 0 THEN 'none' WHEN 1 THEN '8 to 15' WHEN 2 THEN '15 to 30' ELSE 'more than 30' END AS days_policy_claim,
 CASE h3 % 4 WHEN 0 THEN 'none' WHEN 1 THEN '1' WHEN 2 THEN '2 to 4' ELSE 'more than 4' END AS pastnumberofclaims,
 CASE h4 % 8 WHEN 0 THEN 'new' WHEN 7 THEN 'more than 7' ELSE CAST(h4 % 8 + 1 AS STRING) || ' years' END AS ageofvehicle,
 CASE h1 % 9 WHEN 0 THEN '16 to 17' WHEN 1 THEN '18 to 20' WHEN 2 THEN '21 to 25' WHEN 3 THEN '26 to 30' WHEN 4 THEN '31 to 35' WHEN 5 THEN '36 to 40' WHEN 6 THEN '41 to 50' WHEN 7 THEN '51 to 65' ELSE 'over 65' END AS ageofpolicyholder,
 CASE WHEN h2 % 11 = 0 THEN 'Yes' ELSE 'No' END AS policereportfiled,
 CASE WHEN h3 % 13 = 0 THEN 'Yes' ELSE 'No' END AS witnesspresent,
 CASE WHEN h4 % 17 = 0 THEN 'Internal' ELSE 'External' END AS agenttype,
 CASE h1 % 4 WHEN 0 THEN 'none' WHEN 1 THEN '1 to 2' WHEN 2 THEN '3 to 5' ELSE 'more than 5' END AS numberofsuppliments,
 CASE h2 % 9 WHEN 8 THEN 'under 6 months' WHEN 7 THEN '2 to 3 years' WHEN 6 THEN '1 year' WHEN 5 THEN '4 to 8 years' ELSE 'no change' END AS addresschange_claim,
 CASE WHEN h3 % 10 < 8 THEN '1 vehicle' ELSE '2 vehicles' END AS numberofcars,
 CASE WHEN k % 607 = 0 THEN '1800' WHEN k % 613 = 0 THEN 'abc' ELSE CAST(yy AS STRING) END AS year,
 CASE h4 % 3 WHEN 0 THEN 'Liability' WHEN 1 THEN 'Collision' ELSE 'All Perils' END AS basepolicy
FROM b
"""

SCORED_SQL = """
SELECT o_orderkey AS case_id, CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000.0E0 AS p,
       CAST(CASE WHEN (o_orderkey * 104729 + o_custkey) % 100 < 14 THEN 1 ELSE 0 END AS INT) AS y
FROM {orders}
"""

EVALS_SQL = """
SELECT o_orderkey AS case_id, o_orderdate AS fecha_evaluacion,
       CAST((o_orderkey * 7919) % 10001 AS DOUBLE) / 100.0E0 AS ml_probabilidad_fraude,
       CAST(CASE WHEN (o_orderkey * 7919) % 10001 >= 7000 THEN 1 ELSE 0 END AS INT) AS ml_prediccion,
       CAST(NULL AS INT) AS fraude_detectado
FROM {orders}
"""

FEEDBACK_SQL = """
SELECT event_id % 3000 AS case_id, ts AS fecha_validacion, CAST(user_id % 2 AS INT) AS label, event_id
FROM {events}
"""

# What a scoring form sends: plain numbers and dates instead of bands and weeks.
FORMS_SQL = """
SELECT o_orderkey AS case_id, CAST(floor(o_totalprice / 5.0) AS DOUBLE) AS valor_estimado_vehiculo,
       CAST(o_orderkey % 41 AS INT) AS dias_poliza_accidente_min,
       CAST(o_orderkey % 7 AS INT) AS reclamos_pasados_min,
       substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) AS fecha_accidente,
       CASE WHEN o_orderkey % 3 = 0 THEN '2024-12-30' ELSE substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) END AS fecha_reclamo,
       CAST(18 + o_orderkey % 60 AS INT) AS edad,
       CAST(CASE o_custkey % 3 WHEN 0 THEN 300 WHEN 1 THEN 500 ELSE 700 END AS INT) AS deducible,
       CAST(o_orderkey % 4 + 1 AS INT) AS calificacion_conductor,
       CAST(o_orderkey % 5 AS INT) AS semanas_retraso_reporte,
       CAST(o_custkey % 2 AS INT) AS zona_accidente_ml,
       CAST(CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS INT) AS reporte_policial_ml,
       CAST(CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 0 END AS INT) AS testigo_presente_ml,
       CAST(CASE WHEN o_custkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS genero_ml,
       CASE o_orderkey % 3 WHEN 0 THEN 'Responsabilidad Civil' WHEN 1 THEN 'Colisión' ELSE 'Todos los Riesgos' END AS cobertura,
       CASE WHEN o_custkey % 4 = 0 THEN 'Tercero' ELSE 'Titular de Póliza' END AS culpabilidad,
       CASE o_custkey % 3 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'Sport' ELSE 'Utility' END AS categoria_vehiculo,
       CASE o_orderkey % 6 WHEN 0 THEN 'under 6 months' WHEN 1 THEN '2 to 3 years' WHEN 2 THEN '1 year' WHEN 3 THEN '4 to 8 years' WHEN 4 THEN 'other' ELSE 'no change' END AS cambio_direccion,
       CASE o_orderkey % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'more than 7' WHEN 2 THEN '5 years' ELSE '7 years' END AS antiguedad_vehiculo,
       CASE o_custkey % 3 WHEN 0 THEN '26 to 30' WHEN 1 THEN '36 to 40' ELSE 'over 65' END AS edad_titular,
       CASE o_orderkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN '1 to 2' ELSE 'more than 5' END AS numero_suplementos,
       CASE WHEN o_orderkey % 17 = 0 THEN 'Internal' ELSE 'External' END AS tipo_agente
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    """values[index]; a constant array keeps the generated code small."""
    return F.get(F.lit(values), index.cast("int"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claims: 33 text columns with planted dirty rows.

    The same rows as ``CLAIMS_SQL``.  Its long CASE chains compile to a method
    the JVM will not optimise, so they are array lookups here.
    """
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    date = F.col("o_orderdate")

    def mixed(a: int, b: int, m: int) -> Column:
        return (F.col("o_orderkey") * a + F.col("o_custkey") * b) % m

    base = o.join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("tp"), F.year(date).alias("yy"),
        (F.month(date) - 1).alias("m"), F.floor((F.day(date) - 1) / 7).cast("int").alias("w"),
        mixed(7919, 31, 1009).alias("h1"), mixed(104729, 17, 1013).alias("h2"),
        mixed(1299709, 7, 1019).alias("h3"), mixed(15485863, 3, 1021).alias("h4"),
    )
    k, tp, yy, m, w, h1, h2, h3, h4 = (F.col(n) for n in ("k", "tp", "yy", "m", "w", "h1", "h2", "h3", "h4"))

    def every(n: int, value: str | None, otherwise: Column) -> Column:
        return F.when(k % n == 0, F.lit(value)).otherwise(otherwise)

    def text(x: Column) -> Column:
        return x.cast("string")

    def either(condition: Column, yes: str, no: str) -> Column:
        return F.when(condition, yes).otherwise(no)

    category = _pick(h3 % 3, ["Sedan", "Sport", "Utility"])
    coverage = _pick(h4 % 3, ["Liability", "Collision", "All Perils"])
    fraud_bound = F.lit(4) + F.when(h2 % 9 >= 7, 30).otherwise(0) + F.when(h3 % 3 == 2, 8).otherwise(0)
    values = {
        "month": every(503, "0", _pick(m, MONTHS)),
        "weekofmonth": text(w + 1),
        "dayofweek": _pick(h1 % 7, DAYS),
        "make": _pick(h2 % 5, ["Honda", "Toyota", "Ford", "Mazda", "Pontiac"]),
        "accidentarea": every(97, "  Urban \r", either(h3 % 10 == 0, "Rural", "Urban")),
        "dayofweekclaimed": _pick(h2 % 5, DAYS),
        "monthclaimed": every(499, "0", every(617, None, _pick((m + h1 % 2) % 12, MONTHS))),
        "weekofmonthclaimed": text(((w + h2 % 4) % 5 + 1)),
        "sex": either(h3 % 6 == 0, "Female", "Male"),
        "maritalstatus": _pick(h4 % 4, ["Single", "Married", "Widow", "Divorced"]),
        "age": every(701, "-1", every(709, "NA", text(h1 % 60 + 16))),
        "fault": either(h2 % 4 == 0, "Third Party", "Policy Holder"),
        "policytype": every(211, "Sedan", F.concat(category, F.lit(" - "), coverage)),
        "vehiclecategory": category,
        "vehicleprice": every(311, None, _pick(F.least(F.floor(tp / 80000), F.lit(5)), PRICES)),
        "fraudfound_p": either(h4 % 100 < fraud_bound, "1", "0"),
        "policynumber": every(601, None, text(k + 1)),
        "repnumber": text(h1 % 16 + 1),
        "deductible": _pick(F.when(h2 % 4 < 2, h2 % 4).otherwise(h3 % 2 + 2), ["300", "500", "400", "700"]),
        "driverrating": text(h4 % 4 + 1),
        "days_policy_accident": every(401, "More than 30", _pick(F.least(h1 % 12, F.lit(4)), DAY_RANGES)),
        "days_policy_claim": _pick(F.least(h2 % 8, F.lit(3)), ["none", "8 to 15", "15 to 30", "more than 30"]),
        "pastnumberofclaims": _pick(h3 % 4, ["none", "1", "2 to 4", "more than 4"]),
        "ageofvehicle": _pick(h4 % 8, ["new", *[f"{n} years" for n in range(2, 8)], "more than 7"]),
        "ageofpolicyholder": _pick(h1 % 9, HOLDER_AGES),
        "policereportfiled": either(h2 % 11 == 0, "Yes", "No"),
        "witnesspresent": either(h3 % 13 == 0, "Yes", "No"),
        "agenttype": either(h4 % 17 == 0, "Internal", "External"),
        "numberofsuppliments": _pick(h1 % 4, ["none", "1 to 2", "3 to 5", "more than 5"]),
        "addresschange_claim": _pick(F.greatest(h2 % 9 - 4, F.lit(0)), ADDRESS_CHANGES),
        "numberofcars": either(h3 % 10 < 8, "1 vehicle", "2 vehicles"),
        "year": every(607, "1800", every(613, "abc", text(yy))),
        "basepolicy": coverage,
    }
    return base.select(*[value.alias(name) for name, value in values.items()])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, p, y): a score and a label per case."""
    return spark.sql(SCORED_SQL, orders=table(spark, sf_dir, "orders"))


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged evaluations still waiting for review."""
    return spark.sql(EVALS_SQL, orders=table(spark, sf_dir, "orders"))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewer labels, several per case; ``event_id`` gives their order."""
    return spark.sql(FEEDBACK_SQL, events=table(spark, sf_dir, "events"))


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims as a scoring form sends them."""
    return spark.sql(FORMS_SQL, orders=table(spark, sf_dir, "orders"))
