import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd import ROWS, clashing_docs, no_docs
from tokenizers import Tokenizer

from claimflow.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def test_words_give_the_ids_of_whole_texts(spark, sf, plain, monkeypatch):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += [r[1] for r in ROWS] + ["a b c ́x", "don't 12a3 _x_ ﬁ Å Å İ ΑΣ", "<|startoftext|>x<|endoftext|>", "\x1c\x1d\x85 y"]
    texts += ["Éré, Ça. ÀÖØ öøÿ ß. naïve, à ï. x.. ,. a, Ÿ ƒ ½ ª º µ × ÷ e\u0301 don't. l'été, 's It's"]
    texts += [" ".join(f"{chr(c)} a{chr(c)} {chr(c)}b, {chr(c)}." for c in range(1, 0x180))]
    for kept, cut in ((500_000, 1 << 20), (3, 100)):  # also with a full table and texts in slices
        monkeypatch.setattr(tokens, "KEPT", kept)
        monkeypatch.setattr(tokens, "CUT", cut)
        words = tokens.WordTokenizer(PATH)
        for text, code in zip(texts, words.encode(texts)):
            assert np.frombuffer(code, words.kind).tolist() == plain(text)[:-1], text


def check(rows, want, capacity):
    """Every piece stands once, sequences are gapless and not too long; their number."""
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in held.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_odd_rows(spark, plain):
    want = []
    for row in ROWS:
        ids = plain(row[1])
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            want.append((str(row[0]), k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = packing.pack(clashing_docs(spark), PATH).collect()
    total = sum(w[3] for w in want)
    assert check(rows, want, 4096) == -(-total // 4096)
    assert packing.pack(no_docs(spark), PATH).collect() == []


def test_few_sequences(spark):
    rng = np.random.default_rng(2)
    sizes = np.r_[rng.integers(1, 700, 3000), rng.integers(700, 4097, 500), np.full(800, 513)]  # a third are ties
    items = spark.createDataFrame(list(enumerate(sizes.tolist())), "item long, size long")
    rows = packing.assign(items).collect()
    assert len(rows) == len(sizes) and len({r["item"] for r in rows}) == len(sizes)
    load = defaultdict(int)
    for r in rows:
        load[r["bin"]] += int(sizes[r["item"]])
    assert max(load.values()) <= 4096
    assert len(load) <= 1.02 * sizes.sum() / 4096 + 1


def test_across_ranges():
    # part 0 leaves 2 gaps, part 1 has 1 unmatched item and 1 gap, part 2 has 3 items
    assert packing._across([(0, 0, 2), (1, 1, 1), (2, 3, 0)]) == [(1, 0, 1, 0, 0), (2, 0, 1, 1, 0), (2, 1, 1, 0, 1)]
