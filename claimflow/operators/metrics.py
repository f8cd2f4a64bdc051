"""Classifier metrics as DataFrames over (score, label) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import totals_above

WIDE = "decimal(38,0)"


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where whole is 0."""
    return F.when(whole == 0, 0.0).otherwise(F.try_divide(part.cast("double"), whole.cast("double")))


def usable(p: str, y: str) -> Column:
    """Rows a metric can count: a score that is a number, and a label."""
    return F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double")) & F.col(y).isNotNull()


def unscored(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """One row: how many rows the metrics leave out for want of a score or a label."""
    return df.agg(F.count_if(~usable(p, y)).alias("sin_puntaje"), F.count(F.lit(1)).alias("registros"))


def confusion_matrix(df: DataFrame, threshold: float, p: str = "p", y: str = "y") -> DataFrame:
    """One row: tn, fp, fn, tp with p >= threshold counted as positive.

    Rows without a usable score or label are in none of them; ``unscored`` counts those.
    """
    hit, real = F.col(p) >= threshold, F.col(y) == 1
    return df.filter(usable(p, y)).agg(
        F.count_if(~hit & ~real).alias("tn"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"),
        F.count_if(hit & real).alias("tp"),
    )


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def f1_at(df: DataFrame, threshold: float, p: str = "p", y: str = "y") -> DataFrame:
    """F1 of class 1 at a threshold."""
    cm = confusion_matrix(df, threshold, p, y)
    return cm.select(_f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def classification_report(df: DataFrame, threshold: float, p: str = "p", y: str = "y") -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy and means."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    both = confusion_matrix(df, threshold, p, y).select(
        *[
            F.struct(
                F.lit(name).alias("clase"),
                _ratio(right, right + wrong).alias("precision"),
                _ratio(right, right + missed).alias("recall"),
                _f1(right, wrong, missed).alias("f1"),
                (right + missed).alias("support"),
            ).alias(alias)
            for alias, name, right, wrong, missed in (("a", "No Fraude", tn, fn, fp), ("b", "Fraude", tp, fp, fn))
        ],
        _ratio(tn + tp, tn + fp + fn + tp).alias("acc"),
        (tn + fp + fn + tp).alias("n"),
    )

    measures = ("precision", "recall", "f1")

    def summary(name: str, value) -> Column:
        return F.struct(F.lit(name).alias("clase"), *[value(m).alias(m) for m in measures], F.col("n").alias("support"))

    macro = summary("macro avg", lambda m: (F.col(f"a.{m}") + F.col(f"b.{m}")) / 2)
    weighted = summary(
        "weighted avg",
        lambda m: _ratio(F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"), F.col("n")),
    )
    accuracy = summary("accuracy", lambda m: F.col("acc"))
    rows = F.explode(F.array("a", "b", accuracy, macro, weighted)).alias("r")
    return both.select(rows).select("r.*")


def score_table(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """Positives and negatives per distinct score and above it, stored.

    The first aggregate combines equal scores map-side, so one score held by a
    third of the rows costs no more than any other.  Rows without a usable score or
    label are left out.  The functions below take the table of one frame as
    ``table``, to build it once.
    """
    per_score = df.filter(usable(p, y)).groupBy(F.col(p).alias("umbral")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )
    return totals_above(per_score, "umbral", ["pos", "neg"])


def roc_auc(df: DataFrame, p: str = "p", y: str = "y", table: DataFrame | None = None) -> DataFrame:
    """Area under the ROC curve: rank sum over distinct scores, ties half.

    The sums are exact integers; only the last division is floating.  Null if
    one class is missing.
    """
    pos, neg, above = (F.col(c).cast(WIDE) for c in ("pos", "neg", "pos_above"))
    return (table or score_table(df, p, y)).agg(
        F.try_divide(
            F.sum((neg * (2 * above + pos)).cast(WIDE)).cast("double"),
            F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2,
        ).alias("auc")
    )


def pr_curve(df: DataFrame, p: str = "p", y: str = "y", table: DataFrame | None = None) -> DataFrame:
    """Precision and recall with every distinct score as the threshold."""
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    recall = F.when(F.col("pos_total") == 0, 1.0).otherwise(
        F.try_divide(tp.cast("double"), F.col("pos_total").cast("double"))
    )
    return (table or score_table(df, p, y)).select("umbral", _ratio(tp, tp + fp).alias("precision"), recall.alias("recall"))


def best_threshold(
    df: DataFrame, objective: str = "f1", min_precision: float = 0.30, p: str = "p", y: str = "y", table: DataFrame | None = None
) -> DataFrame:
    """The threshold with the best F1, or the best recall at enough precision.

    Ties go to the lowest threshold.  ``recall`` falls back to F1 where no
    threshold reaches ``min_precision``.
    """
    precision, recall = F.col("precision"), F.col("recall")
    f1 = 2 * (precision * recall) / (precision + recall + 1e-9)
    if objective == "f1":
        eligible = F.lit(False)
    elif objective == "recall":
        eligible = precision >= min_precision
    else:
        raise ValueError("objective must be 'f1' or 'recall'")
    return (
        pr_curve(df, p, y, table)
        .withColumns({"f1": f1, "_eligible": eligible})
        .orderBy(F.desc("_eligible"), F.desc(F.when(F.col("_eligible"), recall).otherwise(F.col("f1"))), "umbral")
        .limit(1)
        .drop("_eligible")
    )


def cv_summary(folds: DataFrame, value: str = "auc") -> DataFrame:
    """Mean and population standard deviation over fold results."""
    return folds.agg(
        F.avg(value).alias("media"), F.stddev_pop(value).alias("desviacion"), F.count(value).alias("folds")
    )
