"""Exact splits, also among copies, and the scaling operators."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from claimflow.operators import scale, split


def counts(df, part):
    return {(r.y, r[part]): r["count"] for r in df.groupBy("y", part).count().collect()}


def unique(spark, n=1003, every=7):
    return spark.range(n).select("id", (F.col("id") % every == 0).cast("int").alias("y")).repartition(4)


@pytest.mark.parametrize("fraction", [0.2, 0.25, 0.01, 0.0, 1.0])
def test_split_is_exact_and_whole(spark, fraction):
    df = unique(spark)
    out = split.stratified_split(df, "y", fraction, 42)
    got = counts(out, "parte")
    n = {0: 859, 1: 144}
    test = {c: got.get((c, "test"), 0) for c in n}
    assert sum(test.values()) == math.ceil(fraction * 1003)
    assert all(abs(test[c] - fraction * n[c]) <= 1 for c in n)
    assert out.select("id").distinct().count() == out.count() == 1003


def test_narrowing_step_by_step_finds_the_same_borders(spark, monkeypatch):
    want = split.stratified_split(unique(spark), "y", 0.2, 42)
    monkeypatch.setattr(split, "DIGITS", 1)  # several steps until one hash is left
    got = split.stratified_split(unique(spark), "y", 0.2, 42)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_test_part_and_folds_in_one_go(spark):
    df = unique(spark)
    out = split.split_with_folds(df, "y", 0.2, 5, 42, "part")
    tested = split.stratified_split(df, "y", 0.2, 42).filter("parte = 'test'").select("id")
    same = out.filter("part = 0").select("id")
    assert tested.exceptAll(same).isEmpty() and same.exceptAll(tested).isEmpty()
    sizes = counts(out, "part")
    assert all(max(sizes[y, f] for f in range(1, 6)) - min(sizes[y, f] for f in range(1, 6)) <= 1 for y in (0, 1))


def test_split_follows_hash_order(spark):
    rows = split.stratified_split(unique(spark), "y", 0.2, 42).withColumn("h", split.row_hash(unique(spark), 42)).collect()
    for y in (0, 1):
        test, train = ([r.h for r in rows if r.y == y and r.parte == p] for p in ("test", "train"))
        assert max(test) < min(train)


def test_split_is_repeatable_whatever_the_partitioning(spark):
    a = split.stratified_split(unique(spark), "y", 0.2, 42)
    b = split.stratified_split(unique(spark).repartition(9, "id"), "y", 0.2, 42)
    assert a.exceptAll(b).isEmpty()
    other = split.stratified_split(unique(spark), "y", 0.2, 43)
    assert not a.exceptAll(other).isEmpty()


def test_hot_copies_are_divided_exactly(spark, monkeypatch):
    monkeypatch.setattr(split, "COPY_CHUNK", 64)
    df = spark.range(1200).select(
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 3 == 1).cast("int").alias("y"),
    ).repartition(4)
    out = split.stratified_split(df, "y", 0.2, 1).cache()
    assert counts(out, "parte") == {(0, "test"): 160, (0, "train"): 640, (1, "test"): 80, (1, "train"): 320}
    assert out.select("k", "y").exceptAll(df).isEmpty() and df.exceptAll(out.select("k", "y")).isEmpty()
    all_same = spark.range(1000).select(F.lit("x").alias("k"), F.lit(1).alias("y"))
    folds = split.stratified_folds(all_same, "y", 5)
    assert counts(folds, "fold") == {(1, f): 200 for f in range(5)}


@pytest.mark.parametrize("n, k", [(1003, 5), (10, 3), (4, 5)])
def test_folds_are_even_per_class(spark, n, k):
    out = split.stratified_folds(unique(spark, n, 2), "y", k)
    for y in (0, 1):
        sizes = [counts(out, "fold").get((y, f), 0) for f in range(k)]
        assert max(sizes) - min(sizes) <= 1
    assert out.count() == n


def test_different_rows_hash_apart(spark):
    rows = [("a|b", "c", 1), ("a", "b|c", 1), ("\\N", "", 1), (None, "", 1), ("", None, 1), ("~", None, 1), (None, "~", 1), ("1:a", "b", 1), ("", "1:a", 1)]
    df = spark.createDataFrame(rows, "k string, l string, y int")
    assert df.select(split.row_hash(df, 1).alias("h")).distinct().count() == len(rows)
    many = df.crossJoin(spark.range(10)).drop("id")
    assert sorted(counts(split.stratified_folds(many, "y", 5), "fold").values()) == [18] * 5


def test_other_labels_are_refused(spark):
    with pytest.raises(ValueError):
        split.stratified_split(spark.createDataFrame([(1, 2), (2, None)], "id int, y int"), "y")


def test_empty_frame(spark):
    assert split.stratified_split(spark.createDataFrame([], "id int, y int"), "y").count() == 0


def test_weights_balance_classes(spark):
    out = split.balanced_weights(unique(spark), "y").groupBy("y").agg(F.sum("peso").alias("w")).collect()
    assert [round(r.w, 6) for r in out] == [501.5, 501.5]


def test_standardize(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 5) for v in values], "a double, b int")
    out = [r for r in scale.standardize(df, ["a", "b"]).orderBy("a").collect()]
    m, s = statistics.mean(values), statistics.pstdev(values)
    assert [round(r.a, 12) for r in out] == [round((v - m) / s, 12) for v in values]
    assert {r.b for r in out} == {0.0}


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_categories_are_sorted_and_unseen_is_minus_one(spark, bound):
    # With and without broadcasts: the engine chooses by size.
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, bound)
    fit = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x")], "c string, d string")
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("zz", "x"), (None, "x")], "c string, d string")
    out = [tuple(r) for r in scale.index_categories(df, ["c", "d"], fit).collect()]
    assert sorted(out) == sorted([(0, 0), (1, -1), (2, -1), (-1, 0), (-1, 0)])
    spark.conf.set(key, before)
