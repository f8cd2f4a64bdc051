"""The stages of the pipeline, each held against brute force on its own input."""

import test_lines
import test_packing
import test_simhash
from odd import clashing_docs, no_docs, odd_docs
from tokenizers import Tokenizer

import corpus_pipeline as P
from claimflow.llm import decontaminate, language
from claimflow.sources.scratch import materialize

stages = dict(P.STAGES)


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_follow_one_another(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    known = materialize(stages["language_id"](spark, docs, sf), "test")
    found = language.predict(docs, language.fit(docs)).collect()
    assert rows(known) == {r["doc_id"]: r["text"] for r in found if r["lang_pred"] != "und" and r["score"] >= P.LEAST_SCORE}

    lined = materialize(stages["line_dedup"](spark, known, sf), "test")
    want = test_lines.brute(list(rows(known).items()))
    assert rows(lined) == {k: t for k, t in want.items() if t == rows(known)[k] or t.split()}

    near = materialize(stages["simhash_dedup"](spark, lined, sf), "test")
    keys = list(rows(lined))
    groups = test_simhash.grouped(keys, [test_simhash.plain(rows(lined)[k], 3) for k in keys], 2)
    assert rows(near) == {k: rows(lined)[k] for k, g in zip(keys, groups) if k == g}

    clean = materialize(stages["decontamination"](spark, near, sf), "test")
    automaton = decontaminate.Automaton([(k, decontaminate.words_of(t)) for k, t in bench], decontaminate.WINDOW)
    kept = {}
    for key, text in rows(near).items():
        spans, _ = automaton.scan(decontaminate.words_of(text))
        if sum(b - a for a, b in spans) <= decontaminate.MAX_COVERAGE * len(decontaminate.words_of(text)):
            kept[key] = decontaminate.without_spans(text, [{"lo": a, "hi": b} for a, b in spans])
    assert rows(clean) == kept
    for df in (known, lined, near, clean):
        assert df.dtypes == docs.dtypes

    import zlib

    import numpy as np

    tokenizer = Tokenizer.from_file(test_packing.PATH)
    pieces = []
    for key, text in kept.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            pieces.append((str(key), k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    packed = stages["packing"](spark, clean, sf).collect()
    least = -(-sum(p[3] for p in pieces) // 4096)
    assert test_packing.check(packed, pieces, 4096) <= 1.02 * least + 1


def test_odd_rows(spark, sf):
    for docs in (odd_docs(spark), clashing_docs(spark), no_docs(spark)):
        for name, stage in P.STAGES[:-1]:
            columns = docs.columns
            docs = materialize(stage(spark, docs, sf), "test")
            assert docs.columns == columns, name
        P.STAGES[-1][1](spark, docs, sf).collect()
