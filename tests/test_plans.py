"""The physical plans we rely on at scale."""

import contextlib
import io
import re

import pytest
from claimflow import fixtures
from claimflow.operators import clean, derive, features, kpi, localize, metrics, review, split
from claimflow.plans import claim_queries
from claimflow.sources import schemas, scratch, writers


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def nodes(text, name):
    """Nodes of the plan tree with a name; the details below it are left out."""
    tree = text.split("\n\n")[0]
    return len(re.findall(rf"\b{name} \(", tree))


@pytest.fixture(scope="module")
def curated(spark, sf):
    return scratch.materialize(localize.curate(fixtures.claims(spark, sf)), "curated")


@pytest.fixture(scope="module")
def raw(spark, sf):
    return scratch.materialize(fixtures.claims(spark, sf), "raw")


def test_curating_and_enriching_do_not_shuffle(raw):
    text = plan(derive.enrich(localize.curate(raw)))
    assert nodes(text, "Exchange") == 0 and "Python" not in text


def test_gate_reaches_the_scan(raw):
    assert "IsNotNull(policynumber)" in re.search(r"PushedFilters: (.*)", plan(localize.curate(raw))).group(1)


def test_kpis_shuffle_once_and_read_few_columns(curated):
    text = plan(kpi.segment_kpis(derive.enrich(curated)))
    assert nodes(text, "Exchange") == 1 and nodes(text, "HashAggregate") == 2
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert len(read.split(",")) <= 13 and "estado_civil" not in read
    assert "IsNotNull(mes_reclamo)" in text


def test_top_k_does_not_sort_everything(curated):
    assert "TakeOrderedAndProject" in plan(kpi.top_segments(kpi.segment_kpis(derive.enrich(curated))))


def test_training_frame_is_narrow(curated):
    text = plan(features.training_frame(derive.enrich(curated)))
    assert nodes(text, "Exchange") == 0
    assert "IsNotNull(cobertura)" in text


def test_validated_filter_is_pushed_down(spark, sf):
    log = scratch.materialize(fixtures.evaluations(spark, sf), "log")
    assert "IsNotNull(fraude_detectado)" in re.search(r"PushedFilters: (.*)", plan(review.validated_feedback(log))).group(1)


def test_split_assigns_without_a_shuffle(spark, sf):
    df = scratch.materialize(fixtures.scored(spark, sf).select("case_id", "y"), "scored")
    text = plan(split.stratified_folds(df, "y", 5))
    assert nodes(text, "Exchange") == 0 and nodes(text, "Window") == 0


def test_running_totals_never_put_all_scores_in_one_window(spark, sf):
    text = plan(metrics.pr_curve(fixtures.scored(spark, sf)))
    assert nodes(text, "CartesianProduct") == 0 and nodes(text, "BroadcastNestedLoopJoin") == 0
    # Unpartitioned windows range over wide slices only.
    for order in re.findall(r"Arguments: \[.*?\], \[\](?:, \[(.*?)\])?", text):
        assert "umbral" not in order


def test_no_query_cross_joins(spark, sf):
    for build in (claim_queries.enriched, claim_queries.curated):
        text = plan(build(spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_feedback_is_reduced_before_the_join(spark, sf):
    text = plan(review.resolve_feedback(fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf)))
    assert text.index("Join") < text.index("Aggregate")
    assert nodes(text, "HashAggregate") == 2 and nodes(text, "SortAggregate") == 0


def test_month_less_partition_is_not_read(spark, sf, tmp_path):
    path = str(tmp_path / "landing")
    rows = clean.partition_last(fixtures.claims(spark, sf), "monthclaimed")
    writers.overwrite_partitions(rows, path, ["monthclaimed"])
    text = plan(localize.curate(spark.read.schema(schemas.LANDING_SCHEMA).parquet(path)))
    assert "isnotnull(monthclaimed" in re.search(r"PartitionFilters: (.*)", text).group(1)


def test_bucketed_evaluations_are_not_shuffled(spark, sf, tmp_path):
    evaluations, labels = fixtures.evaluations(spark, sf), fixtures.feedback(spark, sf)
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, rows in (("bucketed.evals", evaluations), ("bucketed.latest", review.latest_feedback(labels))):
            writers.write_bucketed(rows, name, "case_id", 8, str(tmp_path / name))
        evals = spark.table("bucketed.evals")
        resolved = review.resolve_feedback(evals, labels)
        assert nodes(plan(resolved), "Exchange") == 1  # the labels, combined before they move
        assert nodes(plan(review.resolve_feedback(evaluations, labels)), "Exchange") == 2
        assert nodes(plan(review.with_latest(evals, spark.table("bucketed.latest"))), "Exchange") == 0
        want = review.resolve_feedback(evaluations, labels)
        assert resolved.exceptAll(want).isEmpty() and want.exceptAll(resolved).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        spark.sql("DROP DATABASE bucketed CASCADE")
