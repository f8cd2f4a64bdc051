"""Boosted trees and a forest on claim features, trained and applied with MLlib."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from ..sources.readers import require_rows
from ..sources.scratch import materialize
from .boosting import GBTClassifier
from .features import risk_features, training_frame, with_feedback
from .journal import Journal
from .kpi import class_balance
from .metrics import best_threshold, classification_report, confusion_matrix, cv_summary, f1_at, roc_auc, score_table, unscored
from .review import resolve_feedback, score_columns, validated_feedback
from .scale import category_codes, with_codes
from .split import balanced_weights, class_counts, draw, split_with_folds, stratified_folds, stratified_split

WEIGHT = "_peso"
TASK_ROWS = 150_000  # rows of one task of a fit: few, since the forest keeps a weight per row and tree
NODE_IDS = 200_000_000  # rows times trees up to which a forest keeps each row's place in each tree
CUT_ROUNDS = 5  # rounds after which boosting cuts the lineage that each of its tasks carries
ROW_IDS = ("numero_poliza", "case_id")  # tell rows apart when they are split; never model inputs


@dataclass(frozen=True)
class Params:
    """Model parameters; the defaults are fixed values of the full-size model.

    A fit reads all labelled rows.  Only a caller that sets ``fit_rows`` has so many drawn
    exactly, each class by its share, by a hash of the row and its ids; splits, thresholds
    and all metrics use every row even so.
    """

    rounds: int = 300
    rate: float = 0.05
    boosted_depth: int = 4
    boosted_leaf: int = 20
    subsample: float = 0.8
    trees: int = 200
    forest_depth: int = 10
    forest_leaf: int = 10
    feature_subset: str = "sqrt"
    votes: tuple[int, int] = (2, 1)
    test_fraction: float = 0.2
    folds: int = 5
    bins: int = 64
    seed: int = 42
    fit_rows: int | None = None


@dataclass
class Artifact:
    """A fitted model with its category codes, threshold, metrics and test report.

    ``report`` holds small tables of the test part: ``clases`` (precision, recall and
    F1 per class), ``confusion``, ``balance``, ``sin_puntaje`` and ``importancias``;
    and ``validacion``, the area of each fold (no rows without cross-validation).
    """

    model: PipelineModel
    codes: DataFrame
    meta: dict = field(default_factory=dict)
    votes: tuple[int, int] = (2, 1)
    report: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def threshold(self) -> float:
        return self.meta["umbral_optimo"]


def train_boosted(params: Params = Params()) -> GBTClassifier:
    """The boosted member."""
    member = GBTClassifier(
        featuresCol="_features", labelCol=LABEL, predictionCol="_pred_b", maxIter=params.rounds,
        stepSize=params.rate, maxDepth=params.boosted_depth, minInstancesPerNode=params.boosted_leaf,
        subsamplingRate=params.subsample, maxBins=params.bins, seed=params.seed, checkpointInterval=CUT_ROUNDS,
    )
    return member.setProbabilityCol("_prob_b").setRawPredictionCol("_raw_b")


def train_forest(params: Params = Params()) -> RandomForestClassifier:
    """The forest member, classes weighted to balance."""
    return RandomForestClassifier(
        featuresCol="_features", labelCol=LABEL, predictionCol="_pred_f", probabilityCol="_prob_f",
        rawPredictionCol="_raw_f", numTrees=params.trees, maxDepth=params.forest_depth,
        minInstancesPerNode=params.forest_leaf, featureSubsetStrategy=params.feature_subset,
        weightCol=WEIGHT, maxBins=params.bins, seed=params.seed,
    )


def preprocessing() -> list:
    """Stages from feature columns to one vector.

    Category codes ascend with the sorted values; a value not seen in training has
    -1 and lies below every one of them.  ``coded`` adds them.
    """
    return [
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="_numeric", handleInvalid="keep"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(
            inputCols=["_scaled", *[f"_code_{c}" for c in CATEGORICAL_FEATURES]],
            outputCol="_features",
            handleInvalid="keep",
        ),
    ]


def coded(features: DataFrame, codes: DataFrame) -> DataFrame:
    """Features with the code of each category, as the model's stages read them."""
    return with_codes(features, CATEGORICAL_FEATURES, codes)


def build_pipeline(params: Params = Params()) -> Pipeline:
    """Preprocessing and both members as one object to fit."""
    return Pipeline(stages=[*preprocessing(), train_boosted(params), train_forest(params)])


def soft_vote(df: DataFrame, weights: tuple[int, int] = (2, 1), cols=("p1", "p2"), out: str = "p") -> DataFrame:
    """Weighted mean of two probabilities."""
    a, b = weights
    return df.withColumn(out, (F.col(cols[0]) * float(a) + F.col(cols[1]) * float(b)) / float(a + b))


def probabilities(
    features: DataFrame, model: PipelineModel, codes: DataFrame, votes: tuple[int, int], out: str = "p"
) -> DataFrame:
    """Add the ensemble's probability of class 1; null where a feature is missing."""
    scored = model.transform(coded(features, codes)).withColumns(
        {"_p_b": vector_to_array("_prob_b")[1], "_p_f": vector_to_array("_prob_f")[1]}
    )
    voted = soft_vote(scored, votes, ("_p_b", "_p_f"), "_vote")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in NUMERIC_FEATURES + CATEGORICAL_FEATURES])
    return voted.select(*features.columns, F.when(complete, F.col("_vote")).alias(out))


def spread(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows dealt evenly over tasks of at most TASK_ROWS, and stored.

    A fit passes over its rows thousands of times, in as many tasks as there are files.
    Stored rows keep their order when a task is run again.
    """
    return materialize(rows.repartition(max(1, -(-n // TASK_ROWS))), "fit-rows")


def fit_members(rows: DataFrame, params: Params, n: int) -> PipelineModel:
    """The model of ``build_pipeline`` on ``n`` rows, its two members fitted side by side.

    Neither member reads what the other adds.  Both read stored vectors: every task of
    their thousands of jobs is sent the plan its rows come from, which is then one scan.
    The forest keeps the node every row has reached in every tree, rather than walk all
    trees from their roots at each level; beyond NODE_IDS it walks, to the same trees.
    """
    *prepare, boosted, forest = build_pipeline(params).getStages()
    forest.setCacheNodeIds(n * params.trees <= NODE_IDS)
    prepared = Pipeline(stages=prepare).fit(rows)
    ready = materialize(prepared.transform(rows).select("_features", LABEL, WEIGHT), "fit-vectors")
    with ThreadPoolExecutor(2) as pool:
        members = list(pool.map(lambda member: member.fit(ready), (boosted, forest)))
    if members[1].hasSummary:  # it holds the session, which no task can be sent once rows were observed in it
        members[1]._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return PipelineModel([*prepared.stages, *members])


def fit(train_rows: DataFrame, params: Params) -> tuple[PipelineModel, DataFrame]:
    """Fit the whole pipeline on rows of features and label; the model and its category codes.

    Ids of the rows tell them apart when some are drawn, and then go.
    """
    counts = class_counts(train_rows, LABEL)
    codes = category_codes(train_rows, CATEGORICAL_FEATURES)
    rows = train_rows
    if params.fit_rows and sum(counts.values()) > params.fit_rows:
        rows, counts = draw(train_rows, LABEL, params.fit_rows, params.seed + 2)
    weighted = balanced_weights(without_ids(rows), LABEL, WEIGHT, counts)
    n = sum(counts.values())
    return fit_members(spread(coded(weighted, codes), n), params, n), codes


def _folds_auc(
    folded: DataFrame, fold: str, numbers: list[int], params: Params, parallelism: int, journal: Journal | None = None
) -> DataFrame:
    def one(i: int) -> tuple[int, float | None]:
        name = f"fold-{i}"
        known = journal.number(name) if journal else None
        if known is None:
            model, codes = fit(folded.filter(F.col(fold) != i).drop(fold), params)
            held_out = probabilities(without_ids(folded.filter(F.col(fold) == i).drop(fold)), model, codes, params.votes)
            known = (roc_auc(held_out, "p", LABEL).first().auc,)
            if journal:
                journal.keep_number(name, known[0])
        return i - numbers[0], known[0]

    # The loop runs over the few folds; fitting and scoring are Spark jobs.
    with ThreadPoolExecutor(parallelism) as pool:
        results = list(pool.map(one, numbers))
    return folded.sparkSession.createDataFrame(results, "fold int, auc double")


def cross_validate(frame: DataFrame, params: Params = Params(), parallelism: int = 5) -> DataFrame:
    """(fold, auc): each fold scored by a model fitted on the others.

    Folds are fitted side by side: a boosting round on a part of the rows leaves
    executors idle between its many short jobs.
    """
    # Stored first: hashing rows would otherwise copy every feature's expression
    # into each condition on the hash, and the plan would outgrow the driver.
    stored = materialize(frame, "cv-frame")
    folded = materialize(stratified_folds(stored, LABEL, params.folds, params.seed, "_fold"), "folds")
    return _folds_auc(folded, "_fold", list(range(params.folds)), params, parallelism)


def without_ids(frame: DataFrame) -> DataFrame:
    """Only what a model may see, and the columns that say where a row belongs."""
    return frame.drop(*ROW_IDS)


def top_importances(artifact: Artifact, spark: SparkSession, n: int = 15) -> DataFrame:
    """The n inputs the boosted member relies on most."""
    names = NUMERIC_FEATURES + CATEGORICAL_FEATURES
    values = artifact.model.stages[-2].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(names, values)]
    return spark.createDataFrame(rows, "variable string, importancia double").orderBy(
        F.desc("importancia"), "variable"
    ).limit(n)


def train(
    enriched: DataFrame, params: Params = Params(), cross_validation: bool = True, tune_on: str = "test",
    as_of: datetime | None = None, parallelism: int = 5, journal: str | None = None,
) -> Artifact:
    """Features, split, fit, cross-validation, threshold, metrics and report.

    Rows are told apart by their ids, so claims with equal features may go to
    different parts.  ``tune_on="test"`` picks the threshold on the rows it is then
    measured on, which flatters F1; ``"validation"`` sets part of the training rows
    aside.

    ``journal`` names a folder on shared storage that keeps the model and the area of
    each fold once fitted.  A run on the same rows and parameters, such as one that
    starts again after its driver was lost, takes what it finds there.
    """
    if tune_on not in ("test", "validation"):
        raise ValueError("tune_on must be 'test' or 'validation'")
    spark = enriched.sparkSession
    # Written once to shared storage: every later pass reads 29 columns and the ids.
    ids = [c for c in ROW_IDS if c in enriched.columns]
    frame = require_rows(materialize(training_frame(enriched, ids), "training"), "training data")
    # Test part and folds are found together and written once.
    parts = materialize(split_with_folds(frame, LABEL, params.test_fraction, params.folds, params.seed, "_part"), "parts")
    folded, test_rows = parts.filter("_part > 0"), without_ids(parts.filter("_part = 0").drop("_part"))
    train_rows, tune_rows = folded.drop("_part"), test_rows
    if tune_on == "validation":
        inner = stratified_split(folded.drop("_part"), LABEL, params.test_fraction, params.seed + 1, "_part")
        inner = materialize(inner, "validation")
        train_rows = inner.filter("_part = 'train'").drop("_part")
        tune_rows = without_ids(inner.filter("_part = 'test'").drop("_part"))

    log = Journal(spark, journal, frame, f"{params}, {tune_on}") if journal else None
    def of_folds() -> DataFrame:
        if not cross_validation:
            return spark.createDataFrame([], "fold int, auc double")
        return _folds_auc(folded, "_part", list(range(1, params.folds + 1)), params, parallelism, log)

    def scores(rows: DataFrame) -> DataFrame:
        scored = probabilities(rows, model, codes, params.votes).select("p", F.col(LABEL).alias("y"))
        return materialize(scored, "scores")

    # No fold waits for the model, which is fitted and measured meanwhile.
    with ThreadPoolExecutor(1) as beside:
        validated = beside.submit(of_folds)
        fitted = log.model() if log else None
        if fitted is None:
            fitted = fit(train_rows, params)
            if log:
                log.keep_model(*fitted)
        model, codes = fitted
        tested = scores(test_rows)
        table = score_table(tested)
        tuned = table if tune_on == "test" else score_table(scores(tune_rows))
        threshold = best_threshold(tested, table=tuned).first().umbral
        meta = {
            "umbral_optimo": threshold,
            "auc_roc": roc_auc(tested, table=table).first().auc,
            "f1_score": f1_at(tested, threshold).first().f1,
            "cv_media": None,
            "cv_desviacion": None,
            "vars_numericas": list(NUMERIC_FEATURES),
            "vars_categoricas": list(CATEGORICAL_FEATURES),
            "fecha_entrenamiento": (as_of or datetime.now()).isoformat(),
        }
        per_fold = validated.result()
    if cross_validation:
        summary = cv_summary(per_fold).first()
        meta |= {"cv_media": summary.media, "cv_desviacion": summary.desviacion}
    artifact = Artifact(model, codes, meta, params.votes)
    artifact.report = {
        "clases": classification_report(tested, threshold),
        "confusion": confusion_matrix(tested, threshold),
        "balance": class_balance(frame),
        "sin_puntaje": unscored(tested),
        "importancias": top_importances(artifact, spark),
        "validacion": per_fold,
    }
    return artifact


REPORT = ("clases", "confusion", "balance", "sin_puntaje", "importancias", "validacion")
META_SCHEMA = (
    "umbral_optimo double, auc_roc double, f1_score double, cv_media double, cv_desviacion double, "
    "vars_numericas array<string>, vars_categoricas array<string>, fecha_entrenamiento string, votos array<int>"
)


def artifact_meta(artifact: Artifact, spark: SparkSession) -> DataFrame:
    """One row: threshold, metrics, inputs and date."""
    return spark.createDataFrame([{**artifact.meta, "votos": list(artifact.votes)}], META_SCHEMA)


def save_artifact(artifact: Artifact, spark: SparkSession, path: str) -> None:
    """Model folder, category codes, a one-row metadata table and the report's tables."""
    artifact.model.write().overwrite().save(f"{path}/model")
    artifact.codes.write.mode("overwrite").parquet(f"{path}/codes")
    for name, table in artifact.report.items():
        table.write.mode("overwrite").parquet(f"{path}/report/{name}")
    artifact_meta(artifact, spark).write.mode("overwrite").parquet(f"{path}/meta")


def load_artifact(spark: SparkSession, path: str) -> Artifact:
    meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first().asDict()
    votes = tuple(meta.pop("votos"))
    if (meta["vars_numericas"], meta["vars_categoricas"]) != (NUMERIC_FEATURES, CATEGORICAL_FEATURES):
        raise ValueError(f"the model at {path} was trained on other inputs")
    codes = spark.read.schema("columna string, valor string, codigo int").parquet(f"{path}/codes")
    report = {name: spark.read.parquet(f"{path}/report/{name}") for name in REPORT}
    return Artifact(PipelineModel.load(f"{path}/model"), codes, meta, votes, report)


def score(claims: DataFrame, artifact: Artifact) -> DataFrame:
    """All input columns plus probability, decision and alert.

    A claim that lacks a model input stays in the result with nulls.
    """
    scored = probabilities(risk_features(claims), artifact.model, artifact.codes, artifact.votes, "_ensemble")
    return score_columns(scored, artifact.threshold, "_ensemble").select(
        *claims.columns, "probabilidad_fraude", "prediccion_fraude", "nivel_alerta"
    )


def retrain(
    history: DataFrame, evaluations: DataFrame, feedback: DataFrame, params: Params = Params(), **options
) -> Artifact:
    """Train on history plus the evaluations reviewers have labelled."""
    resolved = validated_feedback(resolve_feedback(evaluations, feedback))
    return train(with_feedback(history, resolved), params, **options)
