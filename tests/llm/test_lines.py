import re

from odd import ROWS, clashing_docs, no_docs, odd_docs
from pyspark.sql import functions as F

from claimflow.llm import lines as L


def words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w]


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def alike(a, b):
    """The rule on two lines as words."""
    if a == b:
        return True
    if max(len(a), len(b)) >= L.MIN_WORDS:
        return near(a, b)
    s, t = " ".join(a), " ".join(b)
    return min(len(s), len(t)) >= L.MIN_CHARS and abs(len(s) - len(t)) <= 1 and near(s, t)


def brute(rows):
    """rows of (key, text), keys unique and not null: the text of each without repeated lines."""
    seen, out = [], {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in [] if text is None else text.split("\n"):
            w = words(line)
            if not w or not any(alike(w, v) for v in seen):
                kept.append(line)
            if w:
                seen.append(w)
        out[key] = None if text is None else "\n".join(kept)
    return out


def texts(docs, **options):
    return {r["doc_id"]: r["text"] for r in L.line_dedup(docs, **options).collect()}


def test_edits(spark):
    a = "one two three four five six seven eight nine ten"
    variants = [
        a, a.replace("one", "ONE"), a.replace("five", "5"), a.replace("five ", ""), a.replace("five", "five more"), "zero " + a, a + " end",
        a.replace("one ", ""), a.replace("ten", "10"), a.replace("five", "5").replace("six", "6"), a.replace("two ", "").replace("nine ", ""),
        "one two three four five six seven", "one two three four five six 7", "x " + a.replace("ten", "10"), "", "  ", "tiny", "Tiny",
        "one two three four five six seven eight", "one two three four five six seven 8",
    ]
    rows = [(i, "\n".join(variants[i:] + variants[:i])) for i in (3, 0)] + [(10 + i, v) for i, v in enumerate(variants)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert texts(docs) == brute(rows)


def test_short_lines(spark):
    a = "Share this on Facebook"
    variants = [
        a, a + "!", a.replace("this", "thіs"), a.replace("Share", "Shared"), "share  THIS on\tfacebook", a.replace("on ", ""), a[1:], a[:-1],
        "Share it on Facebook", "1234567890abcdef", "1234567890abcde", "1234567890abcdefg", "1234567890abcdeX", "tiny line", "tiny lines",
        "größer als sechzehn", "grösser als sechzehn", "größer als sechzehm", "a b c d e f g", "a b c d e f h", "a b c d e f g h", "a b c d e f i h",
        "one two three four five six seven", "one two three four five six seven eight", "one two three four five six", "one two three four fiv six seven",
        "日本語の短い行は文字で比べるものである", "日本語の短い行は文字で比べるものでない", "日本語の短い行は文字で比べるものである。",
    ]
    rows = [(i, "\n".join(variants[i:] + variants[:i])) for i in (3, 0)] + [(10 + i, v) for i, v in enumerate(variants)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert texts(docs) == brute(rows)
    pairs = [(1, a), (2, a + "!"), (3, "one two three four five six seven"), (4, "one two three four five six seven eight")]
    assert texts(spark.createDataFrame(pairs, "doc_id long, text string")) == {1: a, 2: "", 3: pairs[2][1], 4: ""}


def test_words_and_characters_do_not_mix(spark):
    # The same sequence once of words, once of characters.
    rows = [(1, " ".join("abcdefghijklmnopqrst")), (2, "abcdefghijklmnopqrsx")]
    assert texts(spark.createDataFrame(rows, "doc_id long, text string")) == dict(rows)


def test_shorter_line_between_longer_ones(spark):
    # the long lines are two edits apart, but each is one from the short one
    base = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join(base[:3] + ["x"] + base[3:])), (2, " ".join(base)), (3, " ".join(base[:9] + ["y"] + base[9:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert texts(docs) == brute(rows) == {1: rows[0][1], 2: "", 3: ""}


def test_documents_equal_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert texts(docs) == brute(rows)


def test_odd_rows(spark):
    docs = clashing_docs(spark)
    out = L.line_dedup(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert dict(got)[1] == ROWS[0][1] and [t for k, t in got if k == 2] == ["", ""]  # equal rows, equal results
    assert dict(got)[5] is None and dict(got)[6] == "" and dict(got)[7] == "  \n\t "
    assert dict(got)[11] == "short line\n"
    kept = {r["doc_id"] for r in L.line_dedup(odd_docs(spark), drop_emptied=True).collect()}
    assert 2 not in kept and {1, 5, 6, 7, 11} <= kept
    assert L.line_dedup(no_docs(spark)).collect() == []


def test_native(spark, sf):
    plan = L.line_dedup(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_is_near(spark):
    cases = [(["a", "b"], ["a", "c"]), (["a", "b"], ["a"]), (["a"], ["b", "a"]), (["a", "b"], ["c", "d"]), (["a", "b"], ["a", "b"]), (["a"], ["a", "b", "c"])]
    df = spark.createDataFrame(cases, "a array<string>, b array<string>")
    assert [r[0] for r in df.select(L._is_near(F.col("a"), F.col("b"))).collect()] == [near(a, b) for a, b in cases]


def test_units_are_hashed_once_for_all_kinds_of_variants(spark):
    rows = [
        (f, (False, i, 1, 0), i, i, 9, 9, True, True, True, True, True, [f"w{j}" for j in range(9)], "abcdefghijklmnopq")
        for i, f in enumerate(("words", "chars"))
    ]
    first = "first struct<no_id:boolean, id:long, th:long, line:int>"
    flags = ", ".join(f"{c} boolean" for c in ("r0", "r1", "s", "l0", "l1"))
    found = L._variants(spark.createDataFrame(rows, f"form string, {first}, h long, h2 int, nw int, n int, {flags}, words array<string>, chars string"))
    # One branch of the plan per form, not one per form and kind.
    assert str(found._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 2
    assert {(r.form, r.kind) for r in found.collect()} == {(f, k) for f in ("words", "chars") for k in ("replace", "longer", "shorter")}


def test_lines_of_white_space_only_are_no_lines(spark):
    white = [" ", "\t", "\x0b", "\x0c", "\r", " \t\x0b\x0c\r", ""]
    kept = ["x", " x", "\u00a0", "\u2003", "\x1f", "\t\x85"]
    docs = spark.createDataFrame([(1, "\n".join(white + kept))], "doc_id long, text string")
    assert [r.content for r in L._lines(docs, "text", "doc_id").collect()] == kept
