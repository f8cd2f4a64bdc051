from collections import Counter

from odd import clashing_docs, no_docs

from claimflow.llm import licenses as L
from claimflow.llm.common import words_of
from claimflow.llm.license_texts import APACHE_HEADER, MIT, TEMPLATES


def dice(a, b):
    a, b = (Counter(zip(w, w[1:])) if len(w) != 1 else Counter([(w[0], b"")]) for w in (a, b))
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


def brute(words):
    best = max(((dice(words, words_of(t)), name) for name, t in TEMPLATES), default=(0, None))
    return best[0] if best[0] >= L.LEAST else None


def test_size_bounds_lose_nothing():
    known = L.Templates(TEMPLATES, L.LEAST)
    full = words_of(MIT)
    cases = [full, full[: len(full) * 7 // 10], full[len(full) // 4 :], full[::2], words_of("MIT"), words_of("Released under the MIT license today"), []]
    cases += [words_of(t) for _, t in TEMPLATES] + [words_of(t)[1:] for _, t in TEMPLATES]
    for words in cases:
        found = known.best(words)
        assert (found[1] if found else None) == brute(words)


def test_units():
    known = L.Templates(TEMPLATES, L.LEAST)
    wrapped = "\n".join(APACHE_HEADER.split("\n"))
    text = f"Some words.\n\n{wrapped}\n\nReleased under the MIT License.\nmore prose follows here"
    found = {(m[0], m[2]) for m in known.scan(text)}
    assert ("Apache-2.0", "block") in found and ("MIT", "line") in found
    assert known.scan(None) == known.scan("") == []
    assert [m[:1] + m[2:] for m in known.scan("x y z\nLICENSED under CC BY-NC 4.0!")] == [("CC-BY-NC-4.0", "line", 1, 1)]


def test_notices_inside_long_documents():
    known = L.Templates(TEMPLATES, L.LEAST)
    prose = " ".join(f"word{i}" for i in range(400))
    mit = MIT.replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    header = "\n".join(f" * {line}" for line in APACHE_HEADER.replace("License. You", "License.\n\nYou").split("\n"))
    for notice, name in ((mit, "MIT"), (header, "Apache-2.0")):
        for text in (f"Copyright me\n\n{notice}\n\n{prose}", f"{prose}\n{notice}\n{prose}\n\n{prose}", f"{prose} {notice.replace(chr(10), ' ')} {prose}"):
            found = [m for m in known.scan(text) if m[2] == "window"]
            assert [m[0] for m in found] == [name] and found[0][1] > 0.95
    assert [m[::2][:2] for m in known.scan(f"{prose} Licensed under CC BY-NC 4.0, {prose}")] == [("CC-BY-NC-4.0", "window")]
    assert known.scan(f"{prose}\n\n{prose}") == []


def test_every_statement_in_documents_is_found(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    for r in L.scan_licenses(docs).collect():
        lines = (r["doc"]["text"] or "").split("\n")
        want = {i for i, line in enumerate(lines) if brute(words_of(line))}
        assert {m["first_line"] for m in r["matches"] if m["unit"] == "line"} == want


def test_odd_rows(spark):
    docs = clashing_docs(spark)
    rows = L.scan_licenses(docs).collect()
    assert len(rows) == docs.count() and all(r["matches"] == [] for r in rows)
    assert L.scan_licenses(no_docs(spark)).collect() == []
    assert all(r["matches"] == [] for r in L.scan_licenses(docs, templates=[]).collect())
