"""Ids by word against the tokenizer on whole texts."""

import random

import numpy as np
import pytest
import test_packing
from odd import LONG, ROWS

from claimflow.llm import tokens as T

PARTS = [
    " ", "\n", "a", "The", "ING", "'s", "'S", "1", "23", ".", ",", "..", ",.", "é", "É", "ü", "中", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "x</w>",
    "\x00", "🙂", "é", "ﬁ", "-", "_", "Foo", "​", "\r\n", "\x85", "\xa0", "ß", "İ", "K", "½", "ÿ", "×", "word. ", "Word, ", "Größe. ",
]


def whole(tokenizer, texts):
    return [e.ids for e in tokenizer.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def ids(tokenizer, texts):
    return [np.frombuffer(code, tokenizer.kind).tolist() for code in tokenizer.encode(texts)]


def test_awkward_texts():
    tokenizer, rng = T.WordTokenizer(test_packing.PATH), random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    assert ids(tokenizer, texts) == whole(tokenizer, texts)


@pytest.mark.parametrize("kept, cut", [(1, 1 << 20), (50, 200), (400_000, 5_000)])
def test_small_tables_and_cuts(monkeypatch, kept, cut):
    monkeypatch.setattr(T, "KEPT", kept)
    monkeypatch.setattr(T, "CUT", cut)
    tokenizer = T.WordTokenizer(test_packing.PATH)
    texts = [r[1] for r in ROWS] + [LONG, "one two one. two, " * 300, None, ""]
    for _ in range(2):
        assert ids(tokenizer, texts) == whole(tokenizer, texts)
        assert len(tokenizer.known) <= kept + 50_000  # what one text needs and no more


def test_vocabulary_without_word_ends():
    tokenizer = T.WordTokenizer(test_packing.PATH)
    tokenizer.ends_word[:] = False
    assert ids(tokenizer, ["plain words here"]) == whole(tokenizer, ["plain words here"])
