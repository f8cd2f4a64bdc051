"""Alignment of two tokenizers: stretches against whole texts, the hash, every column against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from odd import LONG, ROWS, SENTENCE, clashing_docs, no_docs, odd_docs

from claimflow.llm import align as L
from claimflow.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def links_of(text):
    """Ids and links of one whole text, token by token; None if the tokens do not spell it."""
    both = L.aligner(A, B)
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    data = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != data or b"".join(both.bytes_b[i] for i in b) != data:
        return None
    ends_b = {}
    at = 0
    for j, y in enumerate(b):
        at += len(both.bytes_b[y])
        ends_b[at] = j
    at, groups, links, last_a, last_b = 0, [], [], 0, 0
    for i, x in enumerate(a):
        at += len(both.bytes_a[x])
        if at in ends_b:
            j = ends_b[at]
            groups.append(",".join(map(str, a[last_a : i + 1])) + "|" + ",".join(map(str, b[last_b : j + 1])))
            links.append((x, b[j]))
            last_a, last_b = i + 1, j + 1
    return a, b, links, ";".join(groups)


def brute(texts):
    found = [links_of(t) for t in texts]
    counts = Counter(p for f in found if f for p in f[2])
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for f in found:
        a, b, links, groups = f or ([], [], [], "")
        own = [counts[p] for p in links]
        out.append((len(a), len(b), len(links), sum(n == highest[p[1]] for n, p in zip(own, links)), sum(own), groups))
    return out, counts


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 50_000))
    h = L.PerfectHash(np.r_[keys, keys[:9]])
    assert sorted(h.number(keys).tolist()) == list(range(len(keys)))
    assert (h.number(np.setdiff1d(np.arange(5000), keys)) == -1).all()
    none = L.PerfectHash(np.zeros(0, np.int64))
    assert none.n == 0 and none.number(keys[:3]).tolist() == [-1] * 3


def test_ranks_give_the_ids_of_the_tokenizer(sf):
    both, rng = L.aligner(A, B), random.Random(8)
    assert both.ranks is not None
    letters = [chr(rng.choice([*range(32, 127), *range(0xA0, 0x250), 0x2028, 0x3000, 0x4E2D, 0x1F642, 9, 10, 13, 0x1C, 0x85])) for _ in range(300)]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += ["it's IT'S we'll don't 'sx  '  x", "<|endoftext|>", " " * 50 + "x", "a" * 3000]
    for text in texts:
        assert both.ranks.encode_ordinary(text) == both.a.encode(text, add_special_tokens=False).ids
    both = L.Aligner(A, B)
    both.ranks = None  # a vocabulary in another order goes through the tokenizer
    both.look(None)
    both.rows(texts[:50])
    assert both.sizes[: len(both.known), 2].sum() > 0


def test_pairs_are_bounded_by_the_vocabularies():
    both = L.aligner(A, B)
    ends = {}
    for y in both.bytes_b:
        ends[y] = ends.get(y, 0) + 1
    own = set(both.bytes_a)
    suffixes = sum(ends.get(x[k:], 0) for x in own for k in range(len(x)))
    longer = sum(y[k:] in own for y in both.bytes_b for k in range(1, len(y)))
    assert suffixes + longer < 600_000  # all pairs that can end together


def test_stretches_equal_whole_texts():
    both, rng = L.aligner(A, B), random.Random(2)
    parts = [" ", "  ", " ", "\n", "\t", "a", "the", "ing", "'s", "1", "23", ".", ",", "é", "ü", "中", "　", "▁", "<|endoftext|>"]
    parts += ["</s>", "\x00", "\x1c", "🙂", "é", "ﬁ", "<0x0A>", "-", "Foo", "​", "\r\n", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        cut = both.split(text)
        whole, each = links_of(text), [links_of(s) for s in cut]
        assert " ".join(cut) == text
        if whole is None:
            assert None in each
        else:
            assert whole[3] == ";".join(e[3] for e in each) and whole[2] == [p for e in each for p in e[2]]


@pytest.mark.parametrize("small", [False, True])
def test_documents_equal_brute_force(spark, sf, monkeypatch, small):
    if small:  # workers start anew with other settings; here the driver's own process takes the batches
        monkeypatch.setattr(L, "KEPT", 50)
        monkeypatch.setattr(L, "CUT", 700)
        monkeypatch.setattr(L, "SLICE", 90)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r[0] for r in docs.select("text").collect()]
    texts += [None, "", "▁", "bad ▁ one", "x " * 800 + "▁", LONG]
    want, counts = brute(texts)
    if small:
        both = L.Aligner(A, B)
        batch = [L.pa.RecordBatch.from_arrays([L.pa.array(texts)], names=["t"])]
        got = Counter()
        for b in L._task_counts(iter(batch), both):
            got.update(dict(zip(b.column("pair").to_pylist(), b.column("n").to_pylist())))
        assert got == {x * len(both.bytes_b) + y: n for (x, y), n in counts.items()}
        assert [[s for part in both.parts(t) for s in part] for t in texts if t] == [both.split(t) for t in texts if t]
        return
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in L.align(rows.repartition(3), A, B).select("doc.doc_id", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups").collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert {(r["a"], r["b"]): r["n"] for r in L.pair_counts(rows, A, B).collect()} == counts


def test_tree_of_sums(spark, monkeypatch):
    rows = spark.createDataFrame([(i, SENTENCE) for i in range(70)], "doc_id long, text string").repartition(40)
    hashed, counts = L.corpus_counts(rows, A, B)  # more tasks than a fan
    links = Counter(links_of(SENTENCE)[2])
    width = len(L.aligner(A, B).bytes_b)
    assert dict(zip(hashed.keys.tolist(), counts.tolist())) == {x * width + y: 70 * n for (x, y), n in links.items()}


def test_odd_rows(spark):
    want, _ = brute([r[1] for r in ROWS])
    for docs in (odd_docs(spark), clashing_docs(spark)):
        done = L.align(docs, A, B)
        got = done.select("doc.doc_id", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups").collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted((str(r[0]), *w) for r, w in zip(ROWS, want))
        assert done.select("doc.*").columns == docs.columns
    none = spark.createDataFrame([("▁",), (None,)], "text string")  # not a pair in the whole table
    assert [tuple(r)[1:] for r in L.align(none, A, B).collect()] == [(0, 0, 0, 0, 0, "")] * 2
    assert L.align(no_docs(spark), A, B).collect() == [] and L.pair_counts(no_docs(spark), A, B).collect() == []
