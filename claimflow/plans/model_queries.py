"""Queries over scored claims, reviews, splits and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures
from ..fixed_values import CATEGORICAL_FEATURES, EVALUATION_INPUTS, LABEL, NUMERIC_FEATURES
from ..functions.numbers import alert_level
from ..functions.text import iso_week
from ..operators import ensemble, features, metrics, review, scale, split
from ..sources import readers, scratch, writers
from ..streaming import arrivals
from . import training
from .claim_queries import curated, enriched, fixed_time, raw
from .oracles import AS_OF, alert, content_hash
from .registry import query

T = 0.7


# --- bands, alerts and explanations -----------------------------------------

@query("form_fields", "SELECT * FROM derived_forms")
def _(spark, sf):
    return features.form_fields(fixtures.forms(spark, sf))


@query(
    "bucket_label",
    "SELECT case_id, rango_precio_vehiculo, dias_poliza_accidente, reclamos_pasados FROM derived_forms",
)
def _(spark, sf):
    rows = features.form_fields(fixtures.forms(spark, sf))
    return rows.select("case_id", "rango_precio_vehiculo", "dias_poliza_accidente", "reclamos_pasados")


@query(
    "iso_week",
    "SELECT case_id, CAST(week(CAST(fecha_accidente AS DATE)) AS INT) AS semana_accidente, "
    "CAST(week(CAST(fecha_reclamo AS DATE)) AS INT) AS semana_reclamo FROM forms",
)
def _(spark, sf):
    return fixtures.forms(spark, sf).select(
        "case_id", iso_week(F.col("fecha_accidente")).alias("semana_accidente"),
        iso_week(F.col("fecha_reclamo")).alias("semana_reclamo"),
    )


@query(
    "explain_signals",
    "WITH s AS (SELECT case_id, cambio_direccion IN ('under 6 months', '2 to 3 years') AS senal_cambio_reciente, "
    "testigo_presente_ml = 0 AND reporte_policial_ml = 0 AS senal_sin_testigo_ni_reporte, "
    "semanas_retraso_reporte > 0 AS senal_retraso_reporte, dias_poliza_accidente_min <= 15 AS senal_accidente_temprano, "
    "tipo_agente = 'External' AS senal_agente_externo FROM forms) "
    "SELECT *, concat_ws('; ', CASE WHEN senal_cambio_reciente THEN 'Cambio de dirección reciente' END, "
    "CASE WHEN senal_sin_testigo_ni_reporte THEN 'Sin testigo ni reporte policial' END, "
    "CASE WHEN senal_retraso_reporte THEN 'Retraso en reporte' END, "
    "CASE WHEN senal_accidente_temprano THEN 'Accidente temprano en póliza' END, "
    "CASE WHEN senal_agente_externo THEN 'Agente externo' END) AS senales FROM s",
)
def _(spark, sf):
    rows = features.explain_signals(fixtures.forms(spark, sf))
    flags = [c for c in rows.columns if c.startswith("senal_")]
    return rows.select("case_id", *flags, F.array_join("senales", "; ").alias("senales"))


@query("alert_level", f"SELECT case_id, p, {alert('p')} AS nivel_alerta FROM scored")
def _(spark, sf):
    return fixtures.scored(spark, sf).select("case_id", "p", alert_level(F.col("p")).alias("nivel_alerta"))


@query(
    "score_columns",
    "SELECT case_id, round_even(p / 3.0E0 * 10000.0E0, 0) / 10000.0E0 AS probabilidad_fraude, "
    f"CASE WHEN p / 3.0E0 >= 0.25 THEN 1 ELSE 0 END AS prediccion_fraude, {alert('(p / 3.0E0)')} AS nivel_alerta FROM scored",
)
def _(spark, sf):
    rows = fixtures.scored(spark, sf).select("case_id", (F.col("p") / 3.0).alias("p"))
    return review.score_columns(rows, 0.25).drop("p")


@query(
    "evaluation_columns",
    "SELECT case_id, round(round_even(p / 3.0E0 * 10000.0E0, 0) / 10000.0E0 * 100, 2) AS ml_probabilidad_fraude, "
    "CASE WHEN p / 3.0E0 >= 0.25 THEN 1 ELSE 0 END AS ml_prediccion, "
    f"{alert('(p / 3.0E0)')} AS nivel_alerta, CAST(NULL AS INT) AS fraude_detectado, {AS_OF} AS fecha_evaluacion, "
    "CASE WHEN p / 3.0E0 >= 0.25 THEN '¡FRAUDE DETECTADO!' ELSE 'Reclamo Legítimo' END AS etiqueta FROM scored",
)
def _(spark, sf):
    rows = fixtures.scored(spark, sf).select("case_id", (F.col("p") / 3.0).alias("p"))
    logged = review.evaluation_columns(review.score_columns(rows, 0.25).drop("p"), as_of=fixed_time())
    return logged.withColumn("etiqueta", review.verdict(F.col("ml_prediccion")))


# --- metrics ----------------------------------------------------------------

@query("confusion_matrix", "SELECT * FROM confusion")
def _(spark, sf):
    return metrics.confusion_matrix(fixtures.scored(spark, sf), T)


_CLASSES = (
    "WITH m AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp FROM confusion), "
    "c AS (SELECT 'No Fraude' AS clase, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, "
    "2 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM m UNION ALL "
    "SELECT 'Fraude', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM m), "
    "a AS (SELECT * FROM c WHERE clase = 'No Fraude'), b AS (SELECT * FROM c WHERE clase = 'Fraude') "
)


@query(
    "classification_report",
    _CLASSES + "SELECT clase, precision, recall, f1, CAST(support AS BIGINT) AS support FROM c UNION ALL "
    "SELECT 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), "
    "CAST(tn + fp + fn + tp AS BIGINT) FROM m UNION ALL "
    "SELECT 'macro avg', (a.precision + b.precision) / 2, (a.recall + b.recall) / 2, (a.f1 + b.f1) / 2, "
    "CAST(a.support + b.support AS BIGINT) FROM a, b UNION ALL "
    "SELECT 'weighted avg', (a.precision * a.support + b.precision * b.support) / (a.support + b.support), "
    "(a.recall * a.support + b.recall * b.support) / (a.support + b.support), "
    "(a.f1 * a.support + b.f1 * b.support) / (a.support + b.support), CAST(a.support + b.support AS BIGINT) FROM a, b",
)
def _(spark, sf):
    return metrics.classification_report(fixtures.scored(spark, sf), T)


@query("roc_auc", "SELECT auc FROM area")
def _(spark, sf):
    return metrics.roc_auc(fixtures.scored(spark, sf))


# A tenth of the rows has no score, another tenth one that is no number.
_MISSING = "CASE WHEN case_id % 10 = 0 THEN NULL WHEN case_id % 10 = 1 THEN CAST('NaN' AS DOUBLE) ELSE p END AS p"


def _area(source: str) -> str:
    return (
        f"WITH s AS (SELECT {source}, y FROM scored), g AS (SELECT p, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg "
        "FROM s WHERE p IS NOT NULL AND NOT isnan(p) GROUP BY p), "
        "t AS (SELECT pos, neg, sum(pos) OVER (ORDER BY p DESC) - pos AS above FROM g) "
        "SELECT CAST(sum(neg * (2 * above + pos)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc FROM t"
    )


@query("roc_auc_clustered", _area("p * CAST('1e-12' AS DOUBLE) AS p"))
def _(spark, sf):
    return metrics.roc_auc(fixtures.scored(spark, sf).withColumn("p", F.col("p") * 1e-12))


def _with_gaps(spark, sf):
    last = F.col("case_id") % 10
    gap = F.when(last == 0, None).when(last == 1, F.lit(float("nan"))).otherwise(F.col("p"))
    return fixtures.scored(spark, sf).withColumn("p", gap)


@query("roc_auc_missing_scores", _area(_MISSING))
def _(spark, sf):
    return metrics.roc_auc(_with_gaps(spark, sf))


@query(
    "unscored",
    "SELECT count(*) FILTER (case_id % 10 < 2) AS sin_puntaje, count(*) AS registros FROM scored",
)
def _(spark, sf):
    return metrics.unscored(_with_gaps(spark, sf))


@query("f1_at", "SELECT CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) AS f1 FROM confusion")
def _(spark, sf):
    return metrics.f1_at(fixtures.scored(spark, sf), T)


@query("pr_curve", "SELECT * FROM curve")
def _(spark, sf):
    return metrics.pr_curve(fixtures.scored(spark, sf))


@query("best_threshold_f1", "SELECT * FROM curve_f1 ORDER BY f1 DESC, umbral LIMIT 1")
def _(spark, sf):
    return metrics.best_threshold(fixtures.scored(spark, sf), "f1")


# At sf0.01 no threshold of this score is 30 % precise, so both branches are asked for.
@query(
    "best_threshold_recall",
    "SELECT * FROM curve_f1 ORDER BY precision >= 0.14 DESC, CASE WHEN precision >= 0.14 THEN recall ELSE f1 END DESC, umbral LIMIT 1",
)
def _(spark, sf):
    return metrics.best_threshold(fixtures.scored(spark, sf), "recall", 0.14)


@query(
    "best_threshold_recall_default",
    "SELECT * FROM curve_f1 ORDER BY precision >= 0.30 DESC, CASE WHEN precision >= 0.30 THEN recall ELSE f1 END DESC, umbral LIMIT 1",
)
def _(spark, sf):
    return metrics.best_threshold(fixtures.scored(spark, sf), "recall")


_FOLD = "CASE WHEN rn > n_y * 4 // 5 THEN 4 WHEN rn > n_y * 3 // 5 THEN 3 WHEN rn > n_y * 2 // 5 THEN 2 WHEN rn > n_y // 5 THEN 1 ELSE 0 END"


@query(
    "cv_summary",
    f"WITH f AS (SELECT r.y, s.p, {_FOLD} AS fold FROM ranked r JOIN scored s ON r.case_id = s.case_id), "
    "g AS (SELECT fold, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM f GROUP BY fold, p), "
    "t AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY p DESC) - pos AS above FROM g), "
    "u AS (SELECT fold, CAST(sum(neg * (2 * above + pos)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc FROM t GROUP BY fold) "
    "SELECT round(avg(auc), 9) AS media, round(stddev_pop(auc), 9) AS desviacion, count(auc) AS folds FROM u",
)
def _(spark, sf):
    rows = fixtures.scored(spark, sf)
    labelled = split.stratified_folds(rows.select("case_id", "y"), "y", 5)
    scored = scratch.materialize(labelled.join(rows.select("case_id", "p"), "case_id"), "cv")
    per_fold = [(i, metrics.roc_auc(scored.filter(F.col("fold") == i)).first().auc) for i in range(5)]
    summary = metrics.cv_summary(spark.createDataFrame(per_fold, "fold int, auc double"))
    return summary.select(F.round("media", 9).alias("media"), F.round("desviacion", 9).alias("desviacion"), "folds")


# --- splits, weights, scaling ------------------------------------------------

# ceil(n / 5) rows are drawn; classes share them by largest remainder.
_DRAWN = "(n + 4) // 5"
_OTHER = "(n - n_y)"
_TEST = (
    f"n_y * {_DRAWN} // n + CASE WHEN {_DRAWN} - n_y * {_DRAWN} // n - {_OTHER} * {_DRAWN} // n > 0 AND "
    f"(n_y * {_DRAWN} % n > {_OTHER} * {_DRAWN} % n OR (n_y * {_DRAWN} % n = {_OTHER} * {_DRAWN} % n AND y = 0)) THEN 1 ELSE 0 END"
)

# The folds share the rows of a class behind its test part.
_REST, _PLACE = f"(n_y - ({_TEST}))", f"(rn - ({_TEST}))"
_FOLD_REST = " + ".join(f"CASE WHEN {_PLACE} > {_REST} * {j} // 5 THEN 1 ELSE 0 END" for j in (1, 2, 3, 4))


@query(
    "stratified_split",
    f"SELECT case_id, y, CASE WHEN rn <= {_TEST} THEN 'test' ELSE 'train' END AS parte FROM ranked",
)
def _(spark, sf):
    return split.stratified_split(fixtures.scored(spark, sf).select("case_id", "y"), "y", 0.2, 42)


@query(
    "training_parts",
    "WITH sized AS (SELECT fraude_detectado AS y, count(*) OVER (PARTITION BY fraude_detectado) AS n_y, count(*) OVER () AS n FROM complete), "
    f"drawn AS (SELECT DISTINCT y, n_y, {_TEST} AS tested FROM sized) "
    "SELECT y AS fraude_detectado, 'test' AS parte, CAST(tested AS BIGINT) AS registros FROM drawn UNION ALL "
    "SELECT y, 'train', CAST(n_y - tested AS BIGINT) FROM drawn",
)
def _(spark, sf):
    frame = scratch.materialize(features.training_frame(enriched(spark, sf), ["numero_poliza"]), "training")
    parts = split.stratified_split(frame, LABEL, 0.2, 42)
    return parts.groupBy(LABEL, "parte").agg(F.count(F.lit(1)).alias("registros"))


@query(
    "stratified_split_odd_texts",
    "WITH o AS (SELECT case_id, y, CASE case_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '\\N' WHEN 2 THEN 'a|b' WHEN 3 THEN 'a' WHEN 4 THEN '' ELSE '~' END AS t1, "
    "CASE case_id % 6 WHEN 2 THEN 'c' WHEN 3 THEN 'b|c' END AS t2 FROM scored), "
    f"h AS (SELECT *, {content_hash(['case_id', 'y', 't1', 't2'], 42)} AS h, count(*) OVER (PARTITION BY y) AS n_y, count(*) OVER () AS n FROM o), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS rn FROM h) "
    f"SELECT case_id, y, t1, t2, CASE WHEN rn <= {_TEST} THEN 'test' ELSE 'train' END AS parte FROM r",
)
def _(spark, sf):
    k = F.col("case_id") % 6
    odd = fixtures.scored(spark, sf).select(
        "case_id", "y",
        F.when(k == 0, None).when(k == 1, "\\N").when(k == 2, "a|b").when(k == 3, "a").when(k == 4, "").otherwise("~").alias("t1"),
        F.when(k == 2, "c").when(k == 3, "b|c").alias("t2"),
    )
    return split.stratified_split(odd, "y", 0.2, 42)


@query("split_with_folds", f"SELECT case_id, y, CASE WHEN rn <= {_TEST} THEN 0 ELSE 1 + {_FOLD_REST} END AS parte FROM ranked")
def _(spark, sf):
    return split.split_with_folds(fixtures.scored(spark, sf).select("case_id", "y"), "y", 0.2, 5, 42)


@query("stratified_folds", f"SELECT case_id, y, {_FOLD} AS fold FROM ranked")
def _(spark, sf):
    return split.stratified_folds(fixtures.scored(spark, sf).select("case_id", "y"), "y", 5, 42)


@query("balanced_weights", "SELECT case_id, y, CAST(n AS DOUBLE) / (2 * n_y) AS peso FROM hashed")
def _(spark, sf):
    return split.balanced_weights(fixtures.scored(spark, sf).select("case_id", "y"), "y")


_SCALED = ["edad", "deducible", "valor_estimado_vehiculo", "semanas_retraso_reporte", "dias_poliza_accidente_min"]


@query(
    "standardize",
    "SELECT numero_poliza, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _SCALED)
    + " FROM enriched",
)
def _(spark, sf):
    rows = enriched(spark, sf).select("numero_poliza", *_SCALED)
    return scale.standardize(rows, _SCALED).select("numero_poliza", *[F.round(c, 6).alias(c) for c in _SCALED])


@query(
    "index_categories",
    "WITH seen AS (SELECT * FROM curated WHERE categoria_vehiculo <> 'Utility'), "
    + ", ".join(
        f"k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT {c} AS v FROM seen WHERE {c} IS NOT NULL))"
        for c in CATEGORICAL_FEATURES
    )
    + " SELECT numero_poliza, "
    + ", ".join(f"coalesce(k_{c}.code, -1) AS {c}" for c in CATEGORICAL_FEATURES)
    + " FROM curated e "
    + " ".join(f"LEFT JOIN k_{c} ON e.{c} = k_{c}.v" for c in CATEGORICAL_FEATURES),
)
def _(spark, sf):
    rows = curated(spark, sf).select("numero_poliza", *CATEGORICAL_FEATURES)
    return scale.index_categories(rows, CATEGORICAL_FEATURES, rows.filter("categoria_vehiculo <> 'Utility'"))


@query("soft_vote", "SELECT case_id, (p * 2.0E0 + p * p * 1.0E0) / 3.0E0 AS voto FROM scored")
def _(spark, sf):
    rows = fixtures.scored(spark, sf).select("case_id", F.col("p").alias("p1"), (F.col("p") * F.col("p")).alias("p2"))
    return ensemble.soft_vote(rows, (2, 1), out="voto").select("case_id", "voto")


# --- review -----------------------------------------------------------------

@query(
    "review_stats",
    "SELECT count(*) AS total, count(*) FILTER (ml_prediccion = 1) AS fraudes, count(*) FILTER (fraude_detectado IS NULL) AS pendientes, "
    "count(fraude_detectado) AS validados, "
    "CAST(printf('%.1f', CAST(count(*) FILTER (ml_prediccion = 1) AS DOUBLE) / count(*) * 100) AS DOUBLE) AS tasa_fraude FROM resolved",
)
def _(spark, sf):
    return review.review_stats(review.resolve_feedback(fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf)))


@query(
    "review_queue",
    "SELECT * FROM resolved WHERE fraude_detectado IS NULL ORDER BY fecha_evaluacion DESC, case_id LIMIT 50",
)
def _(spark, sf):
    resolved = review.resolve_feedback(fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf))
    return review.review_queue(resolved, 50)


@query(
    "review_view",
    "SELECT case_id, strftime(fecha_evaluacion, '%m/%d %H:%M') AS fecha, printf('%.1f', ml_probabilidad_fraude) || '%' AS probabilidad, "
    "CASE WHEN ml_probabilidad_fraude > 50 THEN 'high' ELSE 'low' END AS banda, "
    "CASE WHEN ml_prediccion = 1 THEN 'FRAUDE' ELSE 'LEGÍTIMO' END AS prediccion, "
    f"CASE WHEN case_id % 7 = 0 THEN '—' ELSE {alert('(ml_probabilidad_fraude / 100)')} END AS nivel FROM evals",
)
def _(spark, sf):
    level = F.when(F.col("case_id") % 7 != 0, alert_level(F.col("ml_probabilidad_fraude") / 100))
    return review.review_view(fixtures.evaluations(spark, sf).withColumn("nivel_alerta", level))


@query(
    "model_card",
    "SELECT CAST(CAST(printf('%.2f', auc * 100) AS DOUBLE) AS VARCHAR) || '%' AS auc_roc, "
    "CAST(CAST(printf('%.2f', CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) * 100) AS DOUBLE) AS VARCHAR) || '%' AS f1_score, "
    "CAST(printf('%.3f', umbral) AS DOUBLE) AS umbral, '2024-01-02' AS entrenado "
    "FROM area JOIN confusion ON true JOIN (SELECT umbral FROM curve_f1 ORDER BY f1 DESC, umbral LIMIT 1) ON true",
)
def _(spark, sf):
    rows = fixtures.scored(spark, sf)
    meta = {
        "auc_roc": metrics.roc_auc(rows).first().auc,
        "f1_score": metrics.f1_at(rows, T).first().f1,
        "umbral_optimo": metrics.best_threshold(rows).first().umbral,
        "fecha_entrenamiento": "2024-01-02T03:04:05",
    }
    schema = "auc_roc double, f1_score double, umbral_optimo double, fecha_entrenamiento string"
    return review.model_card(spark.createDataFrame([meta], schema))


@query("resolve_feedback", "SELECT * FROM resolved")
def _(spark, sf):
    return review.resolve_feedback(fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf))


@query("resolve_feedback_twice", "SELECT * FROM resolved")
def _(spark, sf):
    # A log that holds resolved labels is resolved again, to the same rows.
    labels = fixtures.feedback(spark, sf)
    return review.resolve_feedback(review.resolve_feedback(fixtures.evaluations(spark, sf), labels), labels)


_HISTORY = ["numero_poliza", *EVALUATION_INPUTS, LABEL]


def _labelled_forms(spark, sf):
    """Evaluated forms that reviewers have labelled."""
    rows = features.form_fields(fixtures.forms(spark, sf)).withColumns(
        {"fecha_evaluacion": fixed_time(), "ml_prediccion": F.lit(1), "ml_probabilidad_fraude": F.lit(50.0),
         "fraude_detectado": F.lit(None).cast("int")}
    )
    return review.validated_feedback(review.resolve_feedback(rows, fixtures.feedback(spark, sf)))


@query(
    "with_feedback",
    f"SELECT {', '.join(_HISTORY)}, CAST(NULL AS BIGINT) AS case_id, CAST(NULL AS TIMESTAMP) AS fecha_validacion "
    "FROM (SELECT * REPLACE (CAST(valor_estimado_vehiculo AS DOUBLE) AS valor_estimado_vehiculo) FROM enriched) UNION ALL "
    f"SELECT NULL, {', '.join('f.' + c for c in EVALUATION_INPUTS)}, l.label, f.case_id, l.fecha_validacion "
    "FROM derived_forms f JOIN latest l ON f.case_id = l.case_id",
)
def _(spark, sf):
    return features.with_feedback(enriched(spark, sf).select(*_HISTORY), _labelled_forms(spark, sf))


@query(
    "with_feedback_empty",
    f"SELECT {', '.join(_HISTORY)}, CAST(NULL AS BIGINT) AS case_id, CAST(NULL AS TIMESTAMP) AS fecha_validacion "
    "FROM (SELECT * REPLACE (CAST(valor_estimado_vehiculo AS DOUBLE) AS valor_estimado_vehiculo) FROM enriched)",
)
def _(spark, sf):
    # Without a label yet, the result has the columns it has with one.
    none = _labelled_forms(spark, sf).filter("case_id < 0")
    return features.with_feedback(enriched(spark, sf).select(*_HISTORY), none)


# --- models: trees have no SQL, so SQL says what holds for any of them ---------

_ARTIFACTS: dict[tuple[str, str], ensemble.Artifact] = {}
_CLAIMS: dict[tuple[str, str], DataFrame] = {}


def _claims(spark, sf) -> DataFrame:
    """Enriched claims as a stored table, which a model is trained and applied on, once per session and data folder.

    Derived from raw claims and made features of in one go, they are conditions too large to compile.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CLAIMS:
        _CLAIMS[key] = scratch.materialize(enriched(spark, sf), "model-claims", keep=True)
    return _CLAIMS[key]


def _artifact(spark, sf) -> ensemble.Artifact:
    """One model of full size per session and data folder, trained once for all its queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ARTIFACTS:
        _ARTIFACTS[key] = ensemble.train(_claims(spark, sf))
    return _ARTIFACTS[key]


_BY_CLASS = "SELECT fraude_detectado, count(*) AS registros FROM complete GROUP BY ALL"


@query("train", "SELECT true AS auc_valida, true AS f1_valido, true AS umbral_valido, true AS cv_valida")
def _(spark, sf):
    meta = ensemble.artifact_meta(_artifact(spark, sf), spark)
    return meta.select(
        F.expr("auc_roc > 0.5 AND auc_roc <= 1").alias("auc_valida"),
        F.expr("f1_score > 0 AND f1_score <= 1").alias("f1_valido"),
        F.expr("umbral_optimo > 0 AND umbral_optimo < 1").alias("umbral_valido"),
        F.expr("cv_media > 0.5 AND cv_media <= 1 AND cv_desviacion >= 0").alias("cv_valida"),
    )


@query("train_meta")
def _(spark, sf):
    return ensemble.artifact_meta(_artifact(spark, sf), spark)


_TESTED = f"WITH sized AS (SELECT fraude_detectado AS y, count(*) OVER (PARTITION BY fraude_detectado) AS n_y, count(*) OVER () AS n FROM complete), tested AS (SELECT DISTINCT y, {_TEST} AS k FROM sized) "


@query(
    "training_report",
    _TESTED + "SELECT (SELECT CAST(sum(k) AS BIGINT) FROM tested WHERE y = 0) AS soporte_0, (SELECT CAST(sum(k) AS BIGINT) FROM tested WHERE y = 1) AS soporte_1, "
    "(SELECT CAST(sum(k) AS BIGINT) FROM tested) AS celdas, CAST(0 AS BIGINT) AS sin_puntaje, "
    "(SELECT count(*) FROM complete) AS registros, (SELECT CAST(sum(fraude_detectado) AS BIGINT) FROM complete) AS positivos",
)
def _(spark, sf):
    report = _artifact(spark, sf).report
    support = report["clases"].agg(
        F.sum(F.when(F.col("clase") == "No Fraude", F.col("support"))).alias("soporte_0"),
        F.sum(F.when(F.col("clase") == "Fraude", F.col("support"))).alias("soporte_1"),
    )
    cells = report["confusion"].select((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("celdas"))
    # One row each: joined on a constant key.
    one = F.lit(1).alias("_k")
    rows = [support, cells, report["sin_puntaje"].select("sin_puntaje"), report["balance"].select("registros", "positivos")]
    out = rows[0].select("*", one)
    for r in rows[1:]:
        out = out.join(r.select("*", one), "_k")
    return out.drop("_k")


def _per_member(spark, sf, prediction: str, probability: str):
    artifact = _artifact(spark, sf)
    rows = artifact.model.transform(ensemble.coded(features.training_frame(_claims(spark, sf)), artifact.codes))
    p = vector_to_array(probability)[1]
    # Every complete row has a probability, and is decided by it.
    good = p.between(0, 1) & ((p > 0.5) == (F.col(prediction) == 1))
    return rows.groupBy(LABEL).agg(F.count_if(good).alias("registros"))


@query("train_boosted", _BY_CLASS)
def _(spark, sf):
    return _per_member(spark, sf, "_pred_b", "_prob_b")


@query("train_forest", _BY_CLASS)
def _(spark, sf):
    return _per_member(spark, sf, "_pred_f", "_prob_f")


@query("ensemble_probabilities", _BY_CLASS)
def _(spark, sf):
    artifact = _artifact(spark, sf)
    frame = features.training_frame(_claims(spark, sf))
    scored = ensemble.probabilities(frame, artifact.model, artifact.codes, artifact.votes)
    return scored.groupBy(LABEL).agg(F.count_if(F.col("p").between(0, 1)).alias("registros"))


@query(
    "cross_validate",
    "SELECT fold, true AS auc_valida FROM (VALUES (0), (1), (2), (3), (4)) v(fold)",
)
def _(spark, sf):
    # The folds of the training run; ``ensemble.cross_validate`` gives them for any frame.
    folds = _artifact(spark, sf).report["validacion"]
    return folds.select("fold", F.expr("auc > 0.5 AND auc <= 1").alias("auc_valida"))


@query("top_importances", "SELECT CAST(15 AS BIGINT) AS variables, CAST(15 AS BIGINT) AS conocidas, true AS suman_hasta_uno, true AS ordenadas")
def _(spark, sf):
    top = ensemble.top_importances(_artifact(spark, sf), spark, 15)
    known = F.col("variable").isin(NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    return top.agg(
        F.count_distinct("variable").alias("variables"),
        F.count_if(known).alias("conocidas"),
        F.expr("sum(importancia) > 0 AND sum(importancia) <= 1 + 1e-9").alias("suman_hasta_uno"),
        (F.sort_array(F.collect_list("importancia"), asc=False) == F.collect_list("importancia")).alias("ordenadas"),
    )


def _coherent(claims, artifact):
    """Per claim, whether its score is null or in [0, 1], and decision and alert follow from it."""
    p = F.col("probabilidad_fraude")
    near = F.abs(p - artifact.threshold) <= 5e-5  # the decision is taken before rounding
    decided = near | ((p >= artifact.threshold) == (F.col("prediccion_fraude") == 1))
    edge = F.least(*[F.abs(p - x) for x in (0.2, 0.4, 0.7)]) <= 5e-5
    alerted = edge | (F.col("nivel_alerta") == alert_level(p))
    whole = p.between(0, 1) & decided & alerted
    empty = p.isNull() & F.col("prediccion_fraude").isNull() & F.col("nivel_alerta").isNull()
    scored = ensemble.score(claims, artifact)
    return scored.select("numero_poliza", (F.coalesce(whole, F.lit(False)) | empty).alias("coherente"))


_SCORED = "SELECT numero_poliza, true AS coherente FROM enriched"


@query("score", _SCORED)
def _(spark, sf):
    return _coherent(_claims(spark, sf), _artifact(spark, sf))


@query("artifact_round_trip", _SCORED)
def _(spark, sf):
    # Every claim scored by the model that was saved and loaded.
    path = scratch.scratch_path(spark, "artifact")
    ensemble.save_artifact(_artifact(spark, sf), spark, path)
    return _coherent(_claims(spark, sf), ensemble.load_artifact(spark, path))


@query(
    "score_rows",
    "SELECT e.* EXCLUDE (ml_prediccion, ml_probabilidad_fraude), c.numero_poliza IS NOT NULL AS puntuado "
    "FROM enriched e LEFT JOIN complete c ON e.numero_poliza = c.numero_poliza",
)
def _(spark, sf):
    # Every claim and column comes back; exactly the complete claims have a score.
    scored = ensemble.score(_claims(spark, sf), _artifact(spark, sf))
    has_score = F.col("probabilidad_fraude").between(0, 1) & F.col("prediccion_fraude").isin(0, 1) & F.col("nivel_alerta").isNotNull()
    return scored.withColumn("puntuado", F.coalesce(has_score, F.lit(False))).drop(
        "probabilidad_fraude", "prediccion_fraude", "nivel_alerta", "ml_prediccion", "ml_probabilidad_fraude"
    )


@query("saved_model_scores", "SELECT count(*) AS registros, CAST(0 AS BIGINT) AS distintos FROM enriched")
def _(spark, sf):
    # A saved and loaded model gives each claim the score of the original.
    path = scratch.scratch_path(spark, "artifact")
    original, claims = _artifact(spark, sf), _claims(spark, sf)
    ensemble.save_artifact(original, spark, path)
    again = ensemble.score(ensemble.score(claims, original).withColumnsRenamed(
        {"probabilidad_fraude": "p0", "prediccion_fraude": "d0", "nivel_alerta": "a0"}
    ), ensemble.load_artifact(spark, path))
    same = F.struct("p0", "d0", "a0").eqNullSafe(F.struct("probabilidad_fraude", "prediccion_fraude", "nivel_alerta"))
    return again.agg(F.count(F.lit(1)).alias("registros"), F.count_if(~same).alias("distintos"))


# Forms have every input a model needs, so history and labelled forms are all trained on.
@query(
    "retrain",
    "SELECT (SELECT count(*) FROM complete) + (SELECT count(*) FROM derived_forms f JOIN latest l ON f.case_id = l.case_id) AS registros, "
    "true AS auc_valida, CAST(5 AS BIGINT) AS pliegues, true AS media_valida",
)
def _(spark, sf):
    forms = features.form_fields(fixtures.forms(spark, sf)).withColumn("fraude_detectado", F.lit(None).cast("int"))
    artifact = ensemble.retrain(_claims(spark, sf).select(*_HISTORY), forms, fixtures.feedback(spark, sf))
    # Forms are labelled at random, so any area will do, but each fold has one and the summary is theirs.
    valid = F.lit(0 < artifact.meta["auc_roc"] <= 1)
    folds = artifact.report["validacion"].agg(
        F.count_if(F.expr("auc > 0 AND auc <= 1")).alias("pliegues"),
        (F.abs(F.avg("auc") - F.lit(artifact.meta["cv_media"])) < 1e-9).alias("media_valida"),
    )
    one = F.lit(1).alias("_k")
    return artifact.report["balance"].select("registros", valid.alias("auc_valida"), one).join(folds.select("*", one), "_k").drop("_k")


@query(
    "training_source",
    f"SELECT {', '.join(_HISTORY)}, CAST(NULL AS BIGINT) AS case_id, CAST(NULL AS TIMESTAMP) AS fecha_validacion "
    "FROM (SELECT * REPLACE (CAST(valor_estimado_vehiculo AS DOUBLE) AS valor_estimado_vehiculo) FROM enriched) UNION ALL "
    f"SELECT NULL, {', '.join('f.' + c for c in EVALUATION_INPUTS)}, l.label, f.case_id, l.fecha_validacion "
    "FROM derived_forms f JOIN latest l ON f.case_id = l.case_id",
)
def _(spark, sf):
    # No such table: the CSV export, whose header says table.column, and the labelled forms.
    path = scratch.scratch_path(spark, "history")
    rows = enriched(spark, sf).select(*_HISTORY)
    writers.export_csv(rows.toDF(*[f"fraudes_enriquecido.{c}" for c in rows.columns]), path)
    forms = features.form_fields(fixtures.forms(spark, sf)).withColumn("fraude_detectado", F.lit(None).cast("int"))
    return training.training_source(spark, rows.schema, "no_such_db.fraudes_enriquecido", path, forms, fixtures.feedback(spark, sf))


# --- arriving claims and feedback ---------------------------------------------

@query("enrich_stream", "SELECT * FROM enriched")
def _(spark, sf):
    arriving, out, state = (scratch.scratch_path(spark, n) for n in ("arriving", "enriched", "state"))
    raw(spark, sf).write.parquet(arriving)
    arrivals.enrich_stream(spark, arriving, out, state, as_of=fixed_time())
    return spark.read.schema(enriched(spark, sf).schema).parquet(out)


def _evaluation_log(spark, sf):
    """The log after all forms have arrived."""
    arriving, out, state = (scratch.scratch_path(spark, n) for n in ("forms", "scored", "state"))
    forms, artifact = fixtures.forms(spark, sf).withColumn("case_id", F.col("case_id").cast("string")), _artifact(spark, sf)
    forms.write.parquet(arriving)
    arrivals.score_stream(spark, arriving, out, state, artifact, as_of=fixed_time())
    return readers.read_log(spark, out, arrivals.evaluate_forms(forms, artifact, fixed_time()).schema)


@query("score_stream", "SELECT count(*) AS registros, CAST(0 AS BIGINT) AS distintos FROM forms")
def _(spark, sf):
    # Each form has the score that a batch over the same forms gives it.
    forms = fixtures.forms(spark, sf).withColumn("case_id", F.col("case_id").cast("string"))
    batch = arrivals.evaluate_forms(forms, _artifact(spark, sf), fixed_time())
    cols = ["ml_prediccion", "ml_probabilidad_fraude", "nivel_alerta"]
    batch = batch.select("case_id", F.struct(*cols).alias("b"))
    both = _evaluation_log(spark, sf).select("case_id", F.struct(*cols).alias("s")).join(batch, "case_id", "left")
    return both.agg(F.count(F.lit(1)).alias("registros"), F.count_if(~F.col("s").eqNullSafe(F.col("b"))).alias("distintos"))


@query(
    "score_stream_rows",
    f"SELECT CAST(case_id AS VARCHAR) AS case_id, {', '.join(EVALUATION_INPUTS)}, true AS puntuado, "
    f"CAST(NULL AS INT) AS fraude_detectado, {AS_OF} AS fecha_evaluacion FROM derived_forms",
)
def _(spark, sf):
    # The log holds each arriving form once, with its inputs and a score.
    log = _evaluation_log(spark, sf)
    has_score = F.col("ml_probabilidad_fraude").between(0, 100) & F.col("nivel_alerta").isNotNull()
    return log.select(
        "case_id", *EVALUATION_INPUTS, F.coalesce(has_score, F.lit(False)).alias("puntuado"), "fraude_detectado",
        "fecha_evaluacion",
    )


@query("feedback_stream", "SELECT case_id, label, fecha_validacion FROM latest")
def _(spark, sf):
    arriving, out, state = (scratch.scratch_path(spark, n) for n in ("labels", "feedback", "state"))
    fixtures.feedback(spark, sf).write.parquet(arriving)
    arrivals.feedback_stream(spark, arriving, out, state)
    return review.latest_feedback(readers.read_log(spark, out, arrivals.FEEDBACK_SCHEMA))
