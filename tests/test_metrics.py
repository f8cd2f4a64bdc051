"""Metrics against brute force, over wide and very narrow score ranges."""

import random

import pytest
from pyspark.sql import functions as F

from claimflow.operators import metrics


def make(seed, kind):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.2)
        if kind == "wide":
            p = min(1.0, max(0.0, rng.gauss(0.3 + 0.2 * y, 0.2)))
        elif kind == "coarse":
            p = round(rng.random(), 1)
        elif kind == "narrow":  # one wide slice, one thin slice, many scores
            p = 0.4 + rng.randrange(200) * 1e-13
        else:  # a third of the rows share one score
            p = 0.25 if i % 3 == 0 else rng.random()
        rows.append((p, y))
    return rows


def brute_auc(rows):
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_curve(rows):
    total = sum(y for _, y in rows)
    out = []
    for t in sorted({p for p, _ in rows}):
        tp = sum(y for p, y in rows if p >= t)
        n = sum(1 for p, _ in rows if p >= t)
        out.append((t, tp / n, tp / total))
    return out


@pytest.mark.parametrize("kind", ["wide", "coarse", "narrow", "hot"])
def test_curve_area_and_thresholds(spark, kind):
    rows = make(7, kind)
    df = spark.createDataFrame(rows, "p double, y int").repartition(5)
    assert metrics.roc_auc(df).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)
    curve = [tuple(r) for r in metrics.pr_curve(df).orderBy("umbral").collect()]
    want = brute_curve(rows)
    assert curve == want

    def f1(r):
        return 2 * (r[1] * r[2]) / (r[1] + r[2] + 1e-9)

    best = metrics.best_threshold(df).first()
    assert best.umbral == min(r[0] for r in want if f1(r) == max(map(f1, want)))
    floor = sorted(r[1] for r in want)[len(want) // 2]
    able = [r for r in want if r[1] >= floor]
    assert metrics.best_threshold(df, "recall", floor).first().umbral == min(
        r[0] for r in able if r[2] == max(x[2] for x in able)
    )
    assert metrics.best_threshold(df, "recall", 1.1).first().umbral == best.umbral


def test_area_agrees_with_mllib(spark, sf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from claimflow import fixtures

    df = fixtures.scored(spark, sf).withColumn("y", F.col("y").cast("double"))
    other = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert metrics.roc_auc(df).first().auc == pytest.approx(other.evaluate(df), abs=1e-9)


def test_scores_outside_the_unit_range(spark):
    rows = [(-5.0, 0), (-0.5, 1), (0.5, 0), (1.5, 1), (7.0, 1), (7.0, 0)]
    df = spark.createDataFrame(rows, "p double, y int")
    assert metrics.roc_auc(df).first().auc == pytest.approx(brute_auc(rows))


def test_rows_without_a_score_are_left_out_and_counted(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)]
    odd = [*rows, (None, 1), (None, 0), (float("nan"), 1), (0.5, None)]
    a, b = (spark.createDataFrame(r, "p double, y int") for r in (rows, odd))
    assert metrics.roc_auc(b).first().auc == metrics.roc_auc(a).first().auc == brute_auc(rows)
    assert sorted(metrics.pr_curve(b).collect()) == sorted(metrics.pr_curve(a).collect())
    assert metrics.confusion_matrix(b, 0.75).first() == metrics.confusion_matrix(a, 0.75).first()
    assert tuple(metrics.unscored(b).first()) == (4, 8)
    assert metrics.best_threshold(b).first() == metrics.best_threshold(a).first()


def test_no_window_holds_all_scores(spark):
    from claimflow.operators.running import totals_above

    scores = spark.range(0, 200_000, 1, 8).selectExpr("id * 1e-15 AS s", "1L AS pos")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        out = totals_above(scores.withColumnRenamed("s", "umbral"), "umbral", ["pos"])
        stored = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
        sizes = [r["count"] for r in stored.groupBy("_range").count().collect()]
    finally:
        spark.conf.set(key, "true")
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 60_000
    assert out.filter("pos_above <> 199999 - round(umbral * 1e15)").isEmpty()


def test_confusion_counts_add_up(spark):
    rows = make(3, "wide")
    df = spark.createDataFrame(rows, "p double, y int")
    cm = metrics.confusion_matrix(df, 0.4).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == tuple(
        sum(1 for p, y in rows if (p >= 0.4) == hit and y == real)
        for hit, real in ((False, 0), (True, 0), (False, 1), (True, 1))
    )
    assert sum(cm) == len(rows)
    report = {r.clase: r for r in metrics.classification_report(df, 0.4).collect()}
    assert report["Fraude"].precision == cm.tp / (cm.tp + cm.fp)
    assert report["Fraude"].recall == cm.tp / (cm.tp + cm.fn)
    assert report["accuracy"].f1 == (cm.tp + cm.tn) / len(rows)
    assert report["macro avg"].recall == (report["Fraude"].recall + report["No Fraude"].recall) / 2
    assert report["weighted avg"].support == len(rows)
    assert metrics.f1_at(df, 0.4).first().f1 == pytest.approx(report["Fraude"].f1)


def test_no_prediction_gives_zero_not_an_error(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1)], "p double, y int")
    assert metrics.f1_at(df, 0.9).first().f1 == 0.0
    assert {r.clase: r.precision for r in metrics.classification_report(df, 0.9).collect()}["Fraude"] == 0.0
    one_class = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    assert metrics.roc_auc(one_class).first().auc is None
    assert {r.recall for r in metrics.pr_curve(one_class).collect()} == {1.0}


def test_unknown_objective(spark):
    with pytest.raises(ValueError):
        metrics.best_threshold(spark.createDataFrame([(0.1, 0)], "p double, y int"), "precision")


def test_cv_summary_is_population_deviation(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7)], "fold int, auc double")
    r = metrics.cv_summary(df).first()
    assert (round(r.media, 12), round(r.desviacion, 12), r.folds) == (0.6, 0.1, 2)
