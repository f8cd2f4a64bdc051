"""The registered queries without SQL, held against brute force over whole tables."""

import hashlib
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import test_align
import test_chunks
import test_licenses
import test_packing
import test_runs
import test_simhash
from tokenizers import Tokenizer

from claimflow.llm import chunks, queries, shards
from claimflow.llm.common import words_of


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.fixture(scope="module")
def ids_of(docs):
    tokenizer = Tokenizer.from_file(test_packing.PATH)
    return {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t, _ in docs}


def run(spark, sf, name):
    return queries.QUERIES[name](spark, sf).collect()


def test_op1(spark, sf, docs, ids_of):
    stream = np.array([i for k, _, _ in docs for i in ids_of[k]])
    n = -(-len(stream) // shards.LENGTH)
    stream = np.r_[stream, np.zeros(n * shards.LENGTH - len(stream), int)].astype("<u2").reshape(n, -1)
    rows = run(spark, sf, "op1_token_shards")
    assert sorted(r["slot"] for r in rows) == list(range(n))
    order = shards.Permutation(n, queries.SHARD_KEY).slot(np.arange(n))
    for r in rows:
        assert order[r["sequence"]] == r["slot"] and r["ids_crc32"] == zlib.crc32(stream[r["sequence"]].tobytes())


def test_op2(spark, sf, docs):
    got = {r["doc_id"]: (r["n_matches"], r["license"]) for r in run(spark, sf, "op2_license_scan")}
    for key, text, _ in docs:
        found = [x for line in (text or "").split("\n") if (x := test_licenses.brute(words_of(line)))]
        assert (got[key][0] > 0) == bool(found) and (not found or got[key][1] is not None)


def test_op3(spark, sf, docs):
    rows = {r["doc_id"]: r for r in run(spark, sf, "op3_language_id")}
    assert rows.keys() == {k for k, _, _ in docs}
    right = []
    for key, _, lang in docs:
        assert rows[key]["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2)
        if rows[key]["held_out"]:
            right.append(rows[key]["lang_pred"] == lang)
    assert np.mean(right) > 0.95


def test_op5(spark, sf, docs):
    fps = [test_simhash.plain(t) for _, t, _ in docs]
    roots = test_simhash.grouped([k for k, _, _ in docs], fps, 2)
    want = {(k, f"{f:016x}", c) for (k, _, _), f, c in zip(docs, fps, roots)}
    assert {tuple(r) for r in run(spark, sf, "op5_simhash")} == want


def test_op6(spark, sf):
    said = r"\### Assistant: </turn> ok"
    turns = defaultdict(list, {-7: [(0, "user", said), (1, "assistant", said)]})
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    rows = run(spark, sf, "op6_chat_format")
    assert len(rows) == len(turns)
    for r in rows:
        own = sorted(turns[r["conv_id"]])
        learned = "".join(t for _, role, t in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert r["formatted_chars"] > sum(len(t) for _, _, t in own)


def test_op7(spark, sf, docs):
    got = {r["doc_id"]: r["text"] for r in run(spark, sf, "op7_substring_dedup")}
    seen = set()
    for key, text, _ in sorted(docs):
        data, last, spans = text.encode(), 0, []
        for end in test_chunks.brute(data):
            if data[last:end] in seen:
                spans.append({"lo": last, "hi": end})
            seen.add(data[last:end])
            last = end
        for lo, hi in reversed(chunks.runs_of(spans, chunks.LEAST_RUN)):
            data = data[:lo] + data[hi:]
        assert got[key] == data.decode()


def test_op8(spark, sf, docs, ids_of):
    want = []
    for key, ids in ids_of.items():
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            want.append((str(key), k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    sequences = test_packing.check(run(spark, sf, "op8_pack"), want, 4096)
    assert sequences <= 1.02 * sum(w[3] for w in want) / 4096 + 1


def test_op11(spark, sf, docs):
    want, _ = test_align.brute([t for _, t, _ in docs])
    got = {r["doc_id"]: r for r in run(spark, sf, "op11_token_alignment")}
    assert len(got) == len(docs)
    for (key, _, _), (n_a, n_b, n_links, n_best, total, groups) in zip(docs, want):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert tuple(got[key]) == (key, n_a, n_b, n_links, n_links, n_best, total, digest)


def test_op12(spark, sf, docs):
    got = {r["doc_id"]: tuple(r) for r in run(spark, sf, "op12_periodic_runs")}
    assert len(got) == len(docs)
    some = 0
    for key, text, _ in docs:
        w = test_runs.words(text)
        n, h = len(w), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) < 400:
            found = test_runs.brute(w)
        else:  # brute force is the cube of the words: periods from the places of each word's next copies
            number = {x: i for i, x in enumerate(dict.fromkeys(w))}
            x = np.array([number[v] for v in w])
            found = [r for q in range(1, n // 4 + 1) if (x[q:] == x[:-q]).any() for r in stretches(x, q)]
            found = sorted(r for r in found if not any(r[2] % o[2] == 0 and o[2] < r[2] and o[:2] == r[:2] for o in found))
        some += bool(found)
        best = (None,) * 4
        if found:
            s, length, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
            best = (s, length, q, 1000 * length // q)
        digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        rest = hashlib.sha256(test_runs.left(w, found).encode()).hexdigest()
        assert got[key] == (key, len(found), *best, digest, rest)
    assert some > 5


def stretches(x, q):
    """Stretches of period q, by comparison at that distance."""
    edge = np.diff(np.r_[False, x[q:] == x[:-q], False].astype(int))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        if b + q - a >= max(6, 4 * q):
            yield a, b + q - a, q
