import math
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
from odd import clashing_docs, no_docs, odd_docs

from claimflow.llm import language


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    found = language.predict(docs, language.fit(docs), keep=["doc_id", "lang"])
    rows = found.filter(language.held_out(found["doc_id"])).collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_are_not_learned_from(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wrong = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'xx', lang) AS lang")
    a, b = language.fit(docs), language.fit(wrong)
    assert a.labels == b.labels and np.array_equal(a.log_prob, b.log_prob)


def test_grams_do_not_depend_on_blocks():
    text = "Ein  ganz, normaler Satz; " * 9
    whole = np.sort(np.concatenate([b for b, _ in language._grams([text])]))
    long = text * 9_000  # beyond a block
    counted = np.bincount(np.concatenate([b for b, _ in language._grams([long])]), minlength=1 << 16)
    once = np.bincount(whole, minlength=1 << 16)
    assert set(np.flatnonzero(once)) == set(np.flatnonzero(counted))
    codes = language._codes(long, True)
    assert counted.sum() == (codes != 32).sum() + len(codes) + len(codes) - 1  # one, two and three; a space before


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = language.fit(docs)
    rows = language.predict(docs, model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == docs.count()
    assert all(got[k] == ("und", 0.0) for k in (5, 6, 7, 8))
    assert got[9][0] == "fr" and got[1][0] == "en"
    odd = clashing_docs(spark)
    kept = language.predict(odd.selectExpr("struct(*) AS doc", "text"), model, keep=["doc"]).select("doc.*")
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_nothing_to_learn_from(spark):
    assert language.predict(no_docs(spark), language.fit(no_docs(spark))).collect() == []
    docs = odd_docs(spark).drop("lang").selectExpr("*", "cast(null as string) AS lang")
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs)).collect()} == {"und"}


def plain_grams(text):
    """Buckets of the n-grams of a text, one at a time."""
    codes, mask = [32], (1 << 64) - 1
    for c in text.lower():
        if unicodedata.category(c)[0] == "L":
            codes.append(ord(c))
        elif codes[-1] != 32:
            codes.append(32)
    out = []
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            gram = codes[i : i + n]
            if n == 1 and gram == [32]:
                continue
            h = gram[0]
            for c in gram[1:]:
                h = (h * 0x9E3779B1 & mask) ^ c
            out.append((h * 0xD6E8FEB86659FD93 + n & mask) >> 48)
    return out


def plain_bayes(rows, to_score):
    """Labels and posteriors of multinomial naive Bayes, by loops."""
    counts, sizes = {}, Counter()
    for key, text, label in rows:
        if text is not None and label is not None and (key is None or zlib.crc32(str(key).encode()) % 4 != 2):
            sizes[label] += 1
            counts.setdefault(label, Counter()).update(plain_grams(text))
    out = []
    for text in to_score:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            out.append(("und", 0.0))
            continue
        grams, scores = Counter(plain_grams(text)), {}
        for label, n in counts.items():
            total = sum(n.values()) + 0.5 * (1 << 16)
            scores[label] = math.log(sizes[label] / sum(sizes.values())) + sum(k * math.log((n[g] + 0.5) / total) for g, k in grams.items())
        best = max(sorted(scores), key=scores.get)
        out.append((best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())))
    return out


def test_equals_plain_bayes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(10**6 + i, t, None) for i, t in enumerate(["a", "le", "Und", "é!", "x1y2 z", "", None, "12 34", "İstanbul", "日本 語"])]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = [tuple(r) for r in docs.collect()]
    want = plain_bayes(rows, [t for _, t, _ in rows])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, language.fit(docs), keep=["doc_id"]).collect()}
    for (key, _, _), (label, score) in zip(rows, want):
        assert got[key][0] == label and abs(got[key][1] - score) < 2e-3  # the matrix has 32 bits


def test_memory_does_not_depend_on_the_order():
    long, short = "ein langer Satz " * 250_000, "kurz"

    def peak(texts):
        tracemalloc.start()
        n = sum(len(b) for b, _ in language._grams(texts))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return n, most

    (n, first), (m, second) = peak([long, short]), peak([short, long])
    assert n == m and second < 1.2 * first < 80e6
