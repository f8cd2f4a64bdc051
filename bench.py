"""Headline queries at one scale: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py``.

Prints one JSON line.  Raw claims are first written as delimited text; the layer
runs and everything after them start from files, as in production.  Each query
that only reads runs into a sink that discards its rows, so all columns of all
rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


def main() -> None:
    from session import local_session

    from claimflow import fixtures
    from claimflow.conf import tune
    from claimflow.fixed_values import RAW_COLUMNS
    from claimflow.operators import derive, ensemble, features, kpi, localize, metrics, review, split
    from claimflow.plans import layers
    from claimflow.sources import readers, scratch, writers
    from claimflow.streaming import arrivals

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = tune(local_session(os.environ.get("BENCH_CPUS", "8")))
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        out = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    # Not timed: start-up, and the raw files the layers begin with.
    base = scratch.scratch_path(spark, "bench")
    raw_files = f"{base}/source"
    claims = fixtures.claims(spark, sf_dir).repartition(int(os.environ.get("BENCH_CPUS", "8")))
    writers.write_text_layer(claims.toDF(*RAW_COLUMNS), raw_files)

    workload = timed("layer_workload", lambda: layers.run_workload(spark, "bench", base, raw_files))
    landing = timed("layer_landing", lambda: layers.run_landing(spark, "bench", base, workload))
    curated, _ = timed("layer_curated", lambda: layers.run_curated(spark, "bench", base, landing))
    enriched, kpis = timed("layer_functional", lambda: layers.run_functional(spark, "bench", base, curated))

    timed("quality_report", lambda: drain(kpi.quality_report(spark.table(landing))))
    timed("curate", lambda: drain(localize.curate(spark.table(landing))))
    timed("enrich", lambda: drain(derive.enrich(spark.table(curated))))
    timed("segment_kpis", lambda: drain(kpi.segment_kpis(spark.table(enriched))))
    timed("top_segments", lambda: drain(kpi.top_segments(spark.table(kpis))))
    timed("training_frame", lambda: drain(features.training_frame(spark.table(enriched))))
    timed("export_csv", lambda: writers.export_csv(spark.table(enriched), f"{base}/csv"))
    timed("export_documents", lambda: writers.export_documents(spark.table(kpis), f"{base}/documents"))

    scored, evaluations, labels = (f(spark, sf_dir) for f in (fixtures.scored, fixtures.evaluations, fixtures.feedback))
    timed("classification_report", lambda: drain(metrics.classification_report(scored, 0.5)))
    timed("roc_auc", lambda: drain(metrics.roc_auc(scored)))
    timed("best_threshold", lambda: drain(metrics.best_threshold(scored)))
    timed("stratified_split", lambda: drain(split.stratified_split(scored, "y")))
    timed("stratified_folds", lambda: drain(split.stratified_folds(scored, "y")))
    timed("resolve_feedback", lambda: drain(review.resolve_feedback(evaluations, labels)))
    timed("review_queue", lambda: drain(review.review_queue(evaluations)))

    # The model of full size: 300 rounds, 200 trees, and five folds side by side.
    artifact = timed("train", lambda: ensemble.train(spark.table(enriched)))
    timed("score", lambda: drain(ensemble.score(spark.table(enriched), artifact)))
    timed(
        "enrich_stream",
        lambda: arrivals.enrich_stream(
            spark, raw_files, f"{base}/arrived", f"{base}/state", fmt="csv", options=readers.RAW_OPTIONS
        ),
    )
    print(
        json.dumps(
            {
                "metric": "claims_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "auc": round(artifact.meta["auc_roc"], 4),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
