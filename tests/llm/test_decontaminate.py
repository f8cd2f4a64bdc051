import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from odd import clashing_docs, no_docs, odd_docs

from claimflow.llm import decontaminate as D
from claimflow.llm.common import words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(doc, items, window):
    words = WORD.findall(lowered(doc))
    hit, names = set(), set()
    for name, text in items:
        w = WORD.findall(lowered(text))
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[s : s + n]:
                    hit.update(range(i, i + n))
                    names.add(name)
    return len(words), hit, names


def scanned(doc, items, window):
    automaton = D.Automaton([(k, words_of(t)) for k, t in items], window)
    spans, found = automaton.scan(words_of(doc))
    return len(words_of(doc)), {p for a, b in spans for p in range(a, b)}, {automaton.names[k] for k in found}


letters = st.lists(st.sampled_from("ab c"), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(doc=letters, items=st.lists(letters, max_size=5), window=st.integers(1, 5))
def test_automaton_equals_brute_force(doc, items, window):
    doc, items = " ".join(doc), [(i, " ".join(t)) for i, t in enumerate(items)]
    assert scanned(doc, items, window) == brute(doc, items, window)


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(1, 0x250))) + " Straße ÀÉ 日本 a_b-c 9Z"
    assert [w.decode() for w in words_of(text)] == WORD.findall(lowered(text))


def test_blocks_of_items_add_up(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(80))) for i in range(20)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def run():
        return sorted((r["doc"]["doc_id"], r["n_words"], tuple(map(tuple, r["spans"])), tuple(r["items"])) for r in D.matches(docs, bench).collect())

    once = run()
    monkeypatch.setattr(D, "BLOCK_WORDS", 15)
    assert run() == once
    for key, n, spans, names in once:
        want = brute(rows[key][1], items, D.WINDOW)
        assert (n, {p for a, b in spans for p in range(a, b)}, set(names)) == (want[0], want[1], {str(x) for x in want[2]})


def test_no_text_is_stored_between_automata(spark, monkeypatch):
    stored = []
    keep = D.materialize
    monkeypatch.setattr(D, "materialize", lambda df, name, **more: stored.append(df.columns) or keep(df, name, **more))
    monkeypatch.setattr(D, "BLOCK_WORDS", 5)
    docs = spark.createDataFrame([(1, "a b c d e f", "x")] * 3, "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(i, f"{x} {y} q{i} r{i}") for i, (x, y) in enumerate(["ab", "bc", "cd"])] + [(9, "c d")], "item_id long, text string")
    rows = D.matches(docs, bench).collect()
    assert [r["items"] for r in rows] == [["9"]] * 3 and [tuple(map(tuple, r["spans"])) for r in rows] == [((2, 4),)] * 3
    assert stored and all(columns == ["th", "th2", "spans", "items"] for columns in stored)


def test_passages_are_cut_and_clean_rows_stay(spark):
    item = " ".join(f"item{i}" for i in range(15))
    rows = [(1, "Before that, " + item.upper() + ", and after it came " + "more words " * 20), (2, "clean text"), (3, item + " tail"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (None, "")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, bench).collect()}
    assert got[1].startswith("Before that, , and after it") and "ITEM" not in got[1]
    assert got[2] == "clean text" and got[4] is None
    assert 3 not in got  # mostly benchmark


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "quick brown fox"), (1, "quick brown fox"), (None, "lazy dog"), (2, None)], "item_id long, text string")
    docs = clashing_docs(spark)
    found = D.matches(docs, bench).collect()
    assert len(found) == docs.count()
    assert {r["doc"]["doc_id"]: r["items"] for r in found}[1] == ["1"]
    out = D.decontaminate(docs, bench)
    assert out.columns == docs.columns and out.count() == docs.count()
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(odd_docs(spark), none).count() == docs.count()
    assert D.decontaminate(no_docs(spark), bench).collect() == []
