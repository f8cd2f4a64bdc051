"""Periodic runs: the transforms, the runs and the query against brute force."""

import numpy as np
from odd import LONG, ROWS, clashing_docs, no_docs, odd_docs

from claimflow.llm import runs as R


def brute(x, least=6, times=4):
    """(start, length, period) of all runs, period by period."""
    n, out = len(x), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(least, times * q):
                if not any(q % p == 0 and all(x[k] == x[k + p] for k in range(s, e - p)) for p in range(1, q)):
                    out.append((s, e - s, q))
            i = j + 1
    return sorted(out)


def planted(rng, n, letters):
    x = rng.integers(0, letters, n)
    for _ in range(int(rng.integers(0, 3))):
        a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
        end = int(rng.integers(a, n + 1))
        for i in range(a, end):
            x[i] = x[a + (i - a) % p]
    return x


def test_distances_equal_comparison(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(R, "_CELLS", 256)  # several steps
    for size in (1, 2, 8, 32):
        for letters in (1, 2, 3):
            x = rng.integers(0, letters, 300) * 1_000_003  # sums beyond one prime
            starts = np.arange(0, 300 - 2 * size + 1, size)
            at, far = R.zero_distances(x, starts, size)
            want = {(b, d) for b in starts.tolist() for d in range(size, 2 * size) if b + d + size <= 300 and (x[b : b + size] == x[b + d : b + d + size]).all()}
            assert set(zip(at.tolist(), far.tolist())) == want


def test_runs_equal_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(400):
        x = planted(rng, int(rng.integers(1, 130)), int(rng.integers(1, 4)))
        assert R.runs(x, len(x)) == brute(x.tolist())
    for p in (1, 7, 1000):
        assert R.runs(np.arange(20_000) % p, 20_000) == [(0, 20_000, p)]
    many = np.repeat(np.arange(5000), 6)
    assert R.runs(many, len(many)) == [(6 * i, 6, 1) for i in range(5000)]


def test_texts_do_not_run_into_one_another():
    texts = ["a a a", "a a a", "b a b a b a b a", "a b a b", None, "", "x x x x x x"]
    assert [f for _, f in R._joined(texts)] == [[], [], [(0, 8, 2)], [], [], [], [(0, 6, 1)]]


def words(text):
    return (text or "").encode().split()


def left(w, found):
    return b" ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)).decode()


def test_odd_rows(spark):
    for docs in (odd_docs(spark), clashing_docs(spark)):
        done = R.periodic_runs(docs)
        got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in done.select("doc.doc_id", "n_words", "runs", "collapsed").collect())
        want = []
        for r in ROWS:
            w = words(r[1])
            found = brute(w) if len(w) < 1000 else []  # LONG repeats no word
            want.append((str(r[0]), len(w), found, left(w, found)))
        assert got == sorted(want)
        assert done.select("doc.*").columns == docs.columns
    assert R.periodic_runs(no_docs(spark)).collect() == []


def test_long_text(spark):
    text = LONG + " " + "one two three " * 20_000
    row = R.periodic_runs(spark.createDataFrame([(text,)], "text string")).first()
    n = len(LONG.split())
    assert [tuple(r) for r in row["runs"]] == [(n, 60_000, 3)]
    assert row["collapsed"] == LONG + " one two three"
