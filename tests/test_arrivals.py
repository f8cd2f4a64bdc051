"""Arriving files: each row once, equal to the batch result."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from claimflow import fixtures
from claimflow.operators import derive, kpi, localize, review
from claimflow.sources import readers
from claimflow.streaming import arrivals, state


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_claims_arrive_in_parts(spark, sf, tmp_path):
    arriving, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    claims = fixtures.claims(spark, sf).cache()
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    first, second = "sex = 'Male'", "sex <> 'Male'"
    for part in (first, second):
        claims.filter(part).write.mode("append").parquet(arriving)
        arrivals.enrich_stream(spark, arriving, out, state, as_of=as_of, files_per_batch=1)
    # Nothing new: nothing is added.
    arrivals.enrich_stream(spark, arriving, out, state, as_of=as_of)
    batch = derive.enrich(localize.curate(claims), as_of=as_of)
    assert same(spark.read.schema(batch.schema).parquet(out), batch)


def test_delimited_claims_arrive(spark, sf, tmp_path):
    from claimflow.fixed_values import RAW_COLUMNS
    from claimflow.sources import readers, writers

    arriving, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    claims = fixtures.claims(spark, sf)
    writers.write_text_layer(claims.toDF(*RAW_COLUMNS), arriving)
    arrivals.enrich_stream(spark, arriving, out, state, fmt="csv", options=readers.RAW_OPTIONS)
    assert spark.read.parquet(out).count() == localize.curate(claims).count()


def test_feedback_arrives_twice_for_a_case(spark, tmp_path):
    arriving, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for event, label in ((1, 0), (2, 1)):
        spark.sql(
            f"SELECT 7L AS case_id, timestamp_ntz'2024-01-0{event} 00:00:00' AS fecha_validacion, {label} AS label, {event}L AS event_id"
        ).write.mode("append").parquet(arriving)
        arrivals.feedback_stream(spark, arriving, out, state)
    log = readers.read_log(spark, out, arrivals.FEEDBACK_SCHEMA)
    assert log.count() == 2
    assert [r.label for r in review.latest_feedback(log).collect()] == [1]


FEEDBACK = "case_id long, fecha_validacion timestamp_ntz, label int, event_id long"


def labels(spark, *events):
    rows = [(case, datetime.datetime(2024, 1, 1), label, event) for case, label, event in events]
    return spark.createDataFrame(rows, FEEDBACK)


def held(spark, path):
    return {r.case_id: (r.label, r.event_id) for r in state.feedback_state(spark, path).collect()}


def test_feedback_state(spark, tmp_path):
    path = str(tmp_path)
    assert held(spark, path) == {}
    first = labels(spark, (1, 0, 10), (1, 1, 11), (2, 0, 5), (3, 1, 1), (None, 1, 99))
    state.merge_feedback(first, 0, path, 4)
    assert held(spark, path) == {1: (1, 11), 2: (0, 5), 3: (1, 1)}
    late = labels(spark, (1, 0, 9), (2, 1, 6))  # one older than what is known
    state.merge_feedback(late, 1, path, 4)
    want = {1: (1, 11), 2: (1, 6), 3: (1, 1)}
    assert held(spark, path) == want
    for batch, again in ((1, late), (0, first), (1, late)):  # given once more
        state.merge_feedback(again, batch, path, 4)
        assert held(spark, path) == want
    state.merge_feedback(labels(spark), 2, path, 4)
    with pytest.raises(ValueError, match="4 buckets"):
        state.merge_feedback(late, 3, path, 8)
    touched = len({r[0] for r in late.select(state.bucket_of("case_id", 4)).collect()})
    assert state.vacuum_feedback(spark, path) == touched and held(spark, path) == want


def test_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path)
    state.merge_feedback(labels(spark, *[(i, 0, i) for i in range(400)]), 0, path, 16)
    state.merge_feedback(labels(spark, (7, 1, 1000)), 1, path, 16)
    assert len(glob.glob(f"{path}/data/version=0/bucket=*")) == 16
    assert len(glob.glob(f"{path}/data/version=1/bucket=*")) == 1
    assert held(spark, path) == {i: (0, i) for i in range(400)} | {7: (1, 1000)}


def test_half_a_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path)
    state.merge_feedback(labels(spark, (1, 0, 1)), 0, path, 2)
    state.merge_feedback(labels(spark, (1, 1, 2)), 1, path, 2)
    for f in glob.glob(f"{path}/commits/version=1/*"):
        os.remove(f)  # the driver was lost before the commit
    assert held(spark, path) == {1: (0, 1)}
    state.merge_feedback(labels(spark, (1, 1, 2)), 1, path, 2)
    assert held(spark, path) == {1: (1, 2)}


def test_kpis_of_parts_equal_kpis_of_all(spark, sf):
    enriched = derive.enrich(localize.curate(fixtures.claims(spark, sf)))
    parts = [kpi.segment_partials(enriched.filter(F.pmod("numero_poliza", F.lit(3)) == i)) for i in range(3)]
    merged = kpi.kpis_of_partials(kpi.merge_partials(parts[0].union(parts[1]).union(parts[2])))
    whole = kpi.segment_kpis(enriched)
    assert merged.dtypes == whole.dtypes and merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_repeated_batch_of_claims_counts_once(spark, sf, tmp_path):
    out, partials = str(tmp_path / "out"), str(tmp_path / "partials")
    claims = fixtures.claims(spark, sf)
    parts = [claims.filter("sex = 'Male'"), claims.filter("sex <> 'Male'")]
    for batch in (0, 1, 1, 0):
        arrivals.take_claims(parts[batch], batch, out, partials)
    whole = kpi.segment_kpis(derive.enrich(localize.curate(fixtures.claims(spark, sf))))
    assert arrivals.arrived_kpis(spark, partials).exceptAll(whole).isEmpty()


def test_output_belongs_to_one_checkpoint(spark, tmp_path):
    arriving, kept, first, other = (str(tmp_path / n) for n in ("in", "state", "first", "other"))
    labels(spark, (1, 0, 1)).write.parquet(arriving)
    arrivals.feedback_state_stream(spark, arriving, kept, first)
    labels(spark, (1, 1, 2)).write.mode("append").parquet(arriving)
    with pytest.raises(ValueError, match="written by the stream of"):
        arrivals.feedback_state_stream(spark, arriving, kept, other)
    arrivals.feedback_state_stream(spark, arriving, kept, first)
    assert held(spark, kept) == {1: (1, 2)}
    os.rename(first, other)
    with pytest.raises(ValueError, match="is gone"):
        arrivals.feedback_state_stream(spark, arriving, kept, first)
