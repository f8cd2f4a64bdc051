"""Membership of keys: none is missed, false hits stay rare at any size, the broadcast is bounded."""

import pytest
from pyspark.sql import functions as F

from claimflow.llm import common as C
from claimflow.sources.scratch import materialize


@pytest.mark.parametrize("most", [C.MOST_BYTES, 0])
def test_members(spark, most):
    keys = materialize(spark.createDataFrame([(i * 7919 - 5000,) for i in range(3000)] + [(None,), (1,), (1,)], "k long"), "keys")
    members = C.Members(keys, "k", most)
    assert members.exact == (most == 0)
    rows = keys.union(spark.range(10**12, 10**12 + 20_000).toDF("k"))
    marked = members.mark(rows, "k", "there").cache()
    assert marked.columns == ["k", "there"] and marked.count() == rows.count()
    assert marked.filter("k IS NULL AND there").isEmpty() and marked.filter("there IS NULL").isEmpty()
    assert marked.filter("k < 1000000000000 AND NOT there").isEmpty()
    assert marked.filter("k >= 1000000000000 AND there").count() <= (0 if most == 0 else 200)
    by_column = members.mark(rows, F.col("k") + 0, "there")
    assert by_column.exceptAll(marked).isEmpty()


def test_no_keys(spark):
    none = C.Members(spark.createDataFrame([], "k long"), "k")
    assert none.mark(spark.range(5).toDF("k"), "k").filter("hit").isEmpty()


def test_false_hits_and_bytes_at_size(spark):
    """50 million keys: false hits under 5 %, and the broadcast within its bound."""
    keys = materialize(spark.range(50_000_000).select(F.xxhash64("id").alias("k")), "many-keys")
    members = C.Members(keys, "k")
    assert not members.exact and members.blocks * C.BLOCK_BYTES <= C.MOST_BYTES
    others = spark.range(10**10, 10**10 + 200_000).select(F.xxhash64("id").alias("k"))
    assert members.mark(others, "k").filter("hit").count() < 0.05 * 200_000
    assert members.mark(keys.limit(100_000), "k").filter("NOT hit").isEmpty()
    assert C.Members(keys.limit(10), "k", most_bytes=C.LEAST_BLOCKS * C.BLOCK_BYTES - 1).exact
