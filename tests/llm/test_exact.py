import hashlib
import re
from collections import defaultdict

from odd import ROWS, clashing_docs, no_docs, odd_docs
from pyspark.sql import functions as F

from claimflow.llm.exact import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for text, keys in groups.items():
        keep = min(keys, key=lambda k: (k is None, k))
        first = True
        for k in sorted(keys, key=lambda k: (k is None, k)):
            out.append((k, keep, len(keys), first, hashlib.sha256(text.encode()).hexdigest()))
            first = False
    return sorted(out, key=str)


def run(docs):
    out = exact_dedup(docs, carry={"text_sha256": F.sha2("norm", 256)})
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_odd_rows(spark):
    want = brute([(r[0], r[1]) for r in ROWS])
    assert run(odd_docs(spark)) == want
    assert run(clashing_docs(spark)) == want


def test_empty_table(spark):
    assert run(no_docs(spark)) == []


def test_one_of_repeated_rows_is_kept(spark):
    docs = spark.createDataFrame([(3, "x y")] * 4 + [(5, "x  y")], "doc_id long, text string")
    assert sorted(r["kept"] for r in exact_dedup(docs).collect()) == [False] * 4 + [True]


def test_texts_that_share_length_and_prefix(spark):
    rows = [(i, "p" * 300 + "abc"[i % 3]) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["keep_id"] for r in exact_dedup(docs).collect()} == {i: i % 3 for i in range(9)}


def test_no_text_is_shuffled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "norm" not in plan and " text#" not in plan


def test_rows_without_a_copy_do_not_meet_in_one_task(spark, sf):
    """The join of hashes leaves out rows that have none, which are most."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tree = exact_dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in tree.split("\n") if "Join LeftOuter" in line]
    assert joined and "Union" in tree and "isnotnull(full" in tree
