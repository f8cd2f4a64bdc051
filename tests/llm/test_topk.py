"""Exact top-k search against plain integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.llm import topk as T

MOST = (1 << 63) - 1


def brute(rows, k):
    """Lists of (query id, rank, id, score) over (id, vector) rows whose ids are divisible by 100."""
    usable = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(1024.0 * x) for x in v):
            usable.append((n, i, [math.floor(1024.0 * x) for x in v]))
    out = []
    for n, i, v in usable:
        if i is None or i % 100:
            continue
        scores = []
        for m, j, u in usable:
            if m != n and len(u) == len(v):
                score = min(MOST, max(-MOST - 1, sum(a * b for a, b in zip(u, v))))
                scores.append((-score, j is None, j or 0))
        for rank, (score, free, j) in enumerate(sorted(scores)[:k], 1):
            out.append((i, rank, None if free else j, -score))
    return sorted(out, key=str)


def got(spark, rows, k=10):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted((tuple(r) for r in T.top_k(df, F.col("vec_id") % 100 == 0, k).collect()), key=str)


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    assert got(spark, df) == brute(rows, 10)


@pytest.mark.parametrize("small", [False, True])
def test_ties_copies_and_tiles(spark, monkeypatch, small):
    if small:  # many packed rows, waves, parts and levels of the tree
        for name, value in {"SHARD_ROWS": 7, "BLOCK_ROWS": 2, "WAVE_BYTES": 400, "GROUP_SHARDS": 2, "FAN": 2}.items():
            monkeypatch.setattr(T, name, value)
    rng = np.random.default_rng(6)
    rows = [(int(i), (rng.integers(-2, 3, 3) / 1024).tolist()) for i in rng.permutation(400)]  # many equal scores
    rows += [(0, rows[0][1]), (0, rows[0][1]), (100, [0.5, 0.5, 0.5]), (100, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5])]
    assert got(spark, rows) == brute(rows, 10)
    assert got(spark, rows, 3) == brute(rows, 3)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, None]), (200, None), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]),
        (500, [1e300, -1e300]), (600, [1e306, 1.0]), (-100, [2.5e17, 3.0]), (1, [1e300, 1e300]), (None, [1.0, 2.0]), (None, [1.0, 2.0]),
        (2, []), (700, []), (800, [1.0]), (3, [3.0e6, -7.25]), (4, [-0.0001, 0.0001]), (0, [1.0, 2.0]),
    ]
    assert got(spark, rows) == brute(rows, 10)
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("query", "wave", "part", "pack", "id", "v", "n", "score", "query_id"):
        clash = clash.withColumn(name, F.lit("x"))
    assert got(spark, clash) == brute(rows, 10)
    assert got(spark, []) == [] and got(spark, [(1, [1.0])]) == [] and got(spark, [(100, [1.0])]) == []


def test_operator_with_other_names(spark):
    df = spark.createDataFrame([(1, [0.5]), (2, [0.25]), (3, [1.0])], "k int, v array<float>")
    rows = T.top_k(df, F.col("k") == 1, 2, id="k", vector="v", scale=4).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 3, 8), (1, 2, 2, 2)]
