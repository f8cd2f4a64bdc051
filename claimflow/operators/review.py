"""Scored-claim columns, the review queue and reviewer feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import NO_ALERT, TAG_FRAUD, TAG_LEGIT, VERDICT_FRAUD, VERDICT_LEGIT
from ..functions.numbers import alert_level, fixed_text, flag, round_exact, round_scaled_even


def score_columns(df: DataFrame, threshold: float, p: str = "p") -> DataFrame:
    """Probability to 4 decimals, decision and alert (both on the raw value)."""
    raw = F.col(p)
    return df.withColumns(
        {
            "probabilidad_fraude": round_scaled_even(raw, 4),
            "prediccion_fraude": F.when(raw.isNotNull(), flag(raw >= threshold)),
            "nivel_alerta": alert_level(raw),
        }
    )


def evaluation_columns(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Scored rows -> evaluation log rows: %, decision, alert, label still null."""
    return df.withColumns(
        {
            "ml_prediccion": F.col("prediccion_fraude"),
            "ml_probabilidad_fraude": F.round(F.col("probabilidad_fraude") * 100, 2),
            "fraude_detectado": F.lit(None).cast("int"),
            "fecha_evaluacion": F.current_timestamp() if as_of is None else as_of,
        }
    ).drop("prediccion_fraude", "probabilidad_fraude")


def verdict(prediction: Column) -> Column:
    """Display text of a decision."""
    return F.when(prediction == 1, VERDICT_FRAUD).otherwise(VERDICT_LEGIT)


def validated_feedback(df: DataFrame, label: str = "fraude_detectado") -> DataFrame:
    """Rows a reviewer has labelled; the filter reaches the Parquet scan."""
    return df.filter(F.col(label).isNotNull())


def review_stats(evaluations: DataFrame) -> DataFrame:
    """Totals of the evaluation log in one aggregate."""
    total, frauds = F.count(F.lit(1)), F.count_if(F.col("ml_prediccion") == 1)
    return evaluations.agg(
        total.alias("total"),
        frauds.alias("fraudes"),
        F.count_if(F.col("fraude_detectado").isNull()).alias("pendientes"),
        F.count("fraude_detectado").alias("validados"),
        F.when(total == 0, 0.0).otherwise(round_exact(F.try_divide(frauds, total) * 100, 1)).alias("tasa_fraude"),
    )


def review_queue(evaluations: DataFrame, n: int = 50, key: str = "case_id") -> DataFrame:
    """The newest n cases without a label; ties by key."""
    pending = evaluations.filter(F.col("fraude_detectado").isNull())
    return pending.orderBy(F.desc("fecha_evaluacion"), key).limit(n)


def review_view(queue: DataFrame, key: str = "case_id") -> DataFrame:
    """Display columns of queued cases."""
    p = F.col("ml_probabilidad_fraude")
    alert = F.when(F.col("nivel_alerta") != "", F.col("nivel_alerta")).otherwise(NO_ALERT)
    return queue.select(
        key,
        F.date_format("fecha_evaluacion", "MM/dd HH:mm").alias("fecha"),
        F.concat(fixed_text(p, 1), F.lit("%")).alias("probabilidad"),
        F.when(p > 50, "high").otherwise("low").alias("banda"),
        F.when(F.col("ml_prediccion") == 1, TAG_FRAUD).otherwise(TAG_LEGIT).alias("prediccion"),
        alert.alias("nivel"),
    )


def model_card(meta: DataFrame) -> DataFrame:
    """Display row of a model's metrics; defaults where one is missing."""

    def known(name: str, default) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in meta.columns else F.lit(default)

    return meta.select(
        F.concat(round_exact(known("auc_roc", 0.0) * 100, 2).cast("string"), F.lit("%")).alias("auc_roc"),
        F.concat(round_exact(known("f1_score", 0.0) * 100, 2).cast("string"), F.lit("%")).alias("f1_score"),
        round_exact(known("umbral_optimo", 0.5), 3).alias("umbral"),
        F.substring(known("fecha_entrenamiento", "N/A").cast("string"), 1, 10).alias("entrenado"),
    )


def latest_feedback(
    feedback: DataFrame, order: str = "event_id", key: str = "case_id", keep_order: bool = False
) -> DataFrame:
    """Each case's last label and its time, both of one event; its order too where asked for.

    ``order`` is a whole number; of events with the same one the later wins, then the
    higher label.  One hash aggregate, combined map-side: order, time and label are
    ranked as one number, since a struct would not fit a hash buffer.
    """
    micros = F.coalesce(F.unix_micros(F.col("fecha_validacion").cast("timestamp")), F.lit(0).cast("long"))
    within = (micros * 10 + F.coalesce(F.col("label"), F.lit(-1)) + 1).cast("decimal(18,0)")
    rank = F.col(order).cast("decimal(20,0)") * F.lit(10**17).cast("decimal(18,0)") + within
    kept = ["label", "fecha_validacion", *([order] if keep_order else [])]
    ranked = feedback.select(key, *kept, rank.alias("_rank"))
    return ranked.groupBy(key).agg(*[F.max_by(c, "_rank").alias(c) for c in kept])


def resolve_feedback(
    evaluations: DataFrame, feedback: DataFrame, order: str = "event_id", key: str = "case_id"
) -> DataFrame:
    """Evaluations with the label and time of the last feedback on each case.

    Feedback is reduced to one row per case before the join, so a case with very
    many labels weighs as much as any other.  What a log has resolved already stays
    where no newer feedback is given, so its own output can be resolved again.
    """
    return with_latest(evaluations, latest_feedback(feedback, order, key), key)


def with_latest(evaluations: DataFrame, latest: DataFrame, key: str = "case_id") -> DataFrame:
    """Evaluations with a table of one label and time per case, such as a feedback state.

    Evaluations in buckets of the key (``writers.write_bucketed``) stay where they are:
    only the labels move, or nothing if they lie in as many buckets.
    """
    latest = latest.select(key, F.col("label").alias("_label"), F.col("fecha_validacion").alias("_fecha"))
    joined = evaluations.join(latest, key, "left")
    known = F.col("fecha_validacion") if "fecha_validacion" in evaluations.columns else F.lit(None).cast("timestamp_ntz")
    return joined.withColumns(
        {
            "fraude_detectado": F.coalesce("_label", "fraude_detectado"),
            # With its label comes its time, even where that is missing.
            "fecha_validacion": F.when(F.col("_label").isNotNull(), F.col("_fecha")).otherwise(known),
        }
    ).drop("_label", "_fecha")
