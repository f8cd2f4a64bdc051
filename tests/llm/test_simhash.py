import numpy as np
import xxhash
from odd import ROWS, clashing_docs, no_docs, odd_docs

from claimflow.llm import simhash as S


def plain(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def grouped(keys, fps, radius):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius):
            p, q = find(i), find(int(j))
            parent[max(p, q)] = min(p, q)
    low = {}
    for i, k in enumerate(keys):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return [low.get(find(i)) for i in range(len(fps))]


def test_fingerprint(monkeypatch):
    for text in [None, "", " \n", "one", "one two", "A b c", ROWS[0][1], ROWS[10][1], "é ü x  y\x0bz w"]:
        assert S.fingerprint(text) == plain(text)
    whole = S.fingerprint(ROWS[10][1])
    monkeypatch.setattr(S, "_CUT", 1000)  # long texts are hashed in blocks
    assert S.fingerprint(ROWS[10][1]) == whole


def test_tree_brings_every_pair_together():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = base[:600] ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    fps = np.unique(np.r_[base, near])
    tree = S.Tree(rng.choice(fps, 500), 5, 2)
    row, leaf, home = tree.shards(fps)
    homes = np.empty(len(fps), int)
    homes[row[home]] = leaf[home]
    assert home.sum() == len(fps) and len(np.unique(homes)) > 20
    visits = set(zip(row.tolist(), leaf.tolist()))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 2) + i + 1:
            assert (i, homes[j]) in visits or (int(j), homes[i]) in visits


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "LEAF_ROWS", 64)  # a tree of several levels, and leaves dealt in blocks
    monkeypatch.setattr(S, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64).tolist()
    for f in list(fps[:40]):
        for _ in range(6):  # chains of near fingerprints
            f ^= 1 << int(rng.integers(64))
            fps.append(f)
    fps += [fps[0] ^ 1 << int(b) for b in rng.integers(0, 63, 200)]  # a dense group
    keys = rng.permutation(len(fps)).tolist()
    rows = spark.createDataFrame(list(zip(keys, np.array(fps, np.uint64).view(np.int64).tolist())), "id long, fp long")
    monkeypatch.setattr(S, "fingerprints", lambda *a: rows.selectExpr("id", "0L AS th", "fp"))
    got = {r["doc_id"]: r["component_id"] for r in S.simhash_groups(rows.selectExpr("id AS doc_id")).collect()}
    assert got == dict(zip(keys, grouped(keys, fps, 2)))


def test_no_group_holds_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(S, "LEAF_ROWS", 10_000)  # one leaf
    monkeypatch.setattr(S, "BLOCK_ROWS", 300)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    fps = np.unique(np.r_[base, base[:500] ^ np.uint64(1), base[:200] ^ np.uint64(6)])
    rows = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    sizes, forest = spark.sparkContext.accumulator(0), S._forest
    found = S.links(rows, len(fps), 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "leaf" in plan and "low" in plan and "high" in plan
    links = found.collect()
    groups = grouped(list(range(len(fps))), fps.tolist(), 2)
    assert len({g for g in groups}) == len(fps) - len(components_of(fps, links))
    # Groups as the plan deals them: at most two blocks.
    many = -(-len(fps) // 300)
    assert many > 5


def components_of(fps, links):
    """Links that join two parts: a forest of all given links."""
    parent = {int(f): int(f) for f in fps.view(np.int64)}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    joined = []
    for a, b in links:
        p, q = find(a), find(b)
        if p != q:
            parent[p] = q
            joined.append((a, b))
    return joined


def test_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = docs.select("doc_id", "text").collect()
    keys, fps = [r[0] for r in given], [plain(r[1]) for r in given]
    want = {k: (f, c) for k, f, c in zip(keys, fps, grouped(keys, fps, 2))}
    assert {r[0]: (r[1] % (1 << 64), r[2]) for r in S.simhash_groups(docs).collect()} == want


def test_odd_rows(spark):
    keys, fps = [r[0] for r in ROWS], [plain(r[1]) for r in ROWS]
    want = sorted(zip(map(str, keys), fps, map(str, grouped(keys, fps, 2))))
    for docs in (odd_docs(spark), clashing_docs(spark)):
        got = sorted((str(r[0]), r[1] % (1 << 64), str(r[2])) for r in S.simhash_groups(docs).collect())
        assert got == want
    kept = S.near_dedup(clashing_docs(spark))
    assert kept.columns == clashing_docs(spark).columns
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == sorted({c for c in grouped(keys, fps, 2) if c is not None})
    assert S.simhash_groups(no_docs(spark)).collect() == [] and S.near_dedup(no_docs(spark)).collect() == []
