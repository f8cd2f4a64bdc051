"""Scored rows, queue, feedback, history."""

import datetime

from pyspark.sql import functions as F

from claimflow.operators import features, review

T0 = datetime.datetime(2024, 3, 5, 7, 9)


def evaluations(spark):
    data = [(i, T0 + datetime.timedelta(minutes=i % 3), 12.35 + i, int(i > 4), None) for i in range(8)]
    return spark.createDataFrame(data, "case_id long, fecha_evaluacion timestamp_ntz, ml_probabilidad_fraude double, ml_prediccion int, fraude_detectado int")


def labels(spark):
    data = [(1, T0, 0, 10), (1, T0, 1, 12), (1, T0, 0, 11), (2, T0, 0, 1), (99, T0, 1, 2)]
    return spark.createDataFrame(data, "case_id long, fecha_validacion timestamp_ntz, label int, event_id long")


def test_last_feedback_wins_and_no_case_is_lost(spark):
    out = {r.case_id: r.fraude_detectado for r in review.resolve_feedback(evaluations(spark), labels(spark)).collect()}
    assert out == {0: None, 1: 1, 2: 0, 3: None, 4: None, 5: None, 6: None, 7: None}
    validated = review.validated_feedback(review.resolve_feedback(evaluations(spark), labels(spark)))
    assert sorted(r.case_id for r in validated.collect()) == [1, 2]


def test_resolved_logs_can_be_resolved_again(spark):
    once = review.resolve_feedback(evaluations(spark), labels(spark))
    twice = review.resolve_feedback(once, labels(spark))
    assert twice.columns == once.columns and twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()
    kept = review.resolve_feedback(once, labels(spark).filter("case_id = 2"))
    assert kept.filter("case_id = 1").first().fraude_detectado == 1


def test_label_and_time_come_from_one_event(spark):
    t1 = T0 + datetime.timedelta(days=1)
    tied = spark.createDataFrame([(1, T0, 1, 5), (1, t1, 0, 5)], labels(spark).schema)
    assert tuple(review.latest_feedback(tied).first()) == (1, 0, t1)


def test_a_case_with_many_labels(spark):
    hot = spark.range(30_000).select(
        F.lit(3).cast("long").alias("case_id"), F.lit(T0).cast("timestamp_ntz").alias("fecha_validacion"),
        (F.col("id") == 29_999).cast("int").alias("label"), F.col("id").alias("event_id"),
    )
    out = review.resolve_feedback(evaluations(spark), hot)
    assert out.count() == 8 and out.filter("case_id = 3").first().fraude_detectado == 1


def test_stats(spark):
    resolved = review.resolve_feedback(evaluations(spark), labels(spark))
    assert tuple(review.review_stats(resolved).first()) == (8, 3, 6, 2, 37.5)
    assert tuple(review.review_stats(resolved.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_queue_is_newest_first_with_ties_by_id(spark):
    resolved = review.resolve_feedback(evaluations(spark), labels(spark))
    assert [r.case_id for r in review.review_queue(resolved, 4).collect()] == [5, 4, 7, 0]


def test_view(spark):
    df = spark.createDataFrame(
        [(1, T0, 12.35, 1, "ALTO"), (2, T0, 50.0, 0, ""), (3, T0, 50.01, 0, None)],
        "case_id long, fecha_evaluacion timestamp_ntz, ml_probabilidad_fraude double, ml_prediccion int, nivel_alerta string",
    )
    out = [tuple(r)[1:] for r in review.review_view(df).orderBy("case_id").collect()]
    assert out == [
        ("03/05 07:09", "%.1f%%" % 12.35, "low", "FRAUDE", "ALTO"),
        ("03/05 07:09", "50.0%", "low", "LEGÍTIMO", "—"),
        ("03/05 07:09", "50.0%", "high", "LEGÍTIMO", "—"),
    ]


def test_model_card_defaults(spark):
    card = review.model_card(spark.createDataFrame([(0.87654,)], "auc_roc double")).first()
    assert tuple(card) == ("87.65%", "0.0%", 0.5, "N/A")


def test_scores_are_cut_unrounded(spark):
    df = spark.createDataFrame([(0.20001,), (0.499999,), (None,)], "p double")
    out = [tuple(r)[1:] for r in review.score_columns(df, 0.5).collect()]
    assert out == [(0.2, 0, "MEDIO"), (0.5, 0, "ALTO"), (None, None, None)]
    log = review.evaluation_columns(review.score_columns(df, 0.5)).first()
    assert log.ml_probabilidad_fraude == 20.0 and log.fraude_detectado is None


def test_history_and_feedback(spark):
    history = spark.createDataFrame([("1", 30, 0)], "numero_poliza string, edad int, fraude_detectado int")
    more = spark.createDataFrame([(40, 1, 50.0, "x")], "edad int, fraude_detectado int, ml_probabilidad_fraude double, _id string")
    out = features.with_feedback(history, more)
    assert sorted(map(tuple, out.collect()), key=repr) == [("1", 30, 0), (None, 40, 1)]
    wider = more.withColumn("extra", F.lit("x"))
    assert features.with_feedback(history, wider.limit(0)).columns == features.with_feedback(history, wider).columns


def test_weeks_of_forms_are_those_of_training(spark):
    from claimflow.functions.text import week_of_month

    df = spark.createDataFrame([("2023-12-30",), ("2024-1-3",), ("2024-02-07",), ("2024-02-08",), ("no date",), (None,)], "d string")
    assert [r[0] for r in df.select(week_of_month(F.col("d"))).collect()] == [5, 1, 1, 2, None, None]
