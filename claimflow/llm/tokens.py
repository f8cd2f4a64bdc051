"""Token ids of whole texts by a public tokenizer file, a word at a time.

The tokenizer's words never span ASCII white space, so the ids of a text are those
of its white-space separated pieces, joined.  Pieces are looked up in a table of
bounded size that lives as long as a task; only new ones are encoded.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import accumulate, chain

import numpy as np

KEPT = 400_000  # pieces of a generation of the table; two are held at most, some 150 MB
CUT = 1 << 20  # bytes of text in hand at once
# Pieces that the tokenizer's own steps leave as they are but for lower case: letters of
# Latin-1, perhaps with a mark behind, which is a word of its own.  All others go
# through those steps one by one.
_PLAIN = re.compile("([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,]?)")
_WORD_END = "</w>"  # how the vocabulary marks a token that ends a word
_MARK = "\0"  # stands for it in what is encoded by ranks; no plain word holds it
# How byte-level vocabularies spell a byte: printable ones as themselves, the others in
# order from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELT = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _by_rank(path: str):
    """The vocabulary as ranks of byte strings, if its merges stand in the order of their ids; else None.

    An end of a word becomes a byte of its own, which joins the byte before it first.
    Plain words get the same ids several times faster.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("end_of_word_suffix") != _WORD_END or model.get("continuing_subword_prefix"):
        return None
    vocab = model["vocab"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    size = 512 + len(merged)  # bytes, bytes that end a word, one token per merge
    if [vocab.get(m) for m in merged] != list(range(512, size)):
        return None
    ranks = {}
    for token, i in vocab.items():
        bare = token.removesuffix(_WORD_END)
        if i < size and (i < 256) == (token == bare and len(token) == 1) and (len(bare) == 1) >= (i < 512):
            ranks[bytes(SPELT[c] for c in bare) + (_MARK.encode() if bare != token else b"")] = i
    if sorted(ranks.values()) != list(range(size)):
        return None
    return tiktoken.Encoding("words", pat_str=f"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks, special_tokens={})


class WordTokenizer:
    """Ids of texts in ``kind``: two bytes an id where the vocabulary fits, else four; little-endian."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already uses every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith(_WORD_END)
        self.ranks = _by_rank(path)
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}  # the generation before; what is used again moves on
        self.marks = {mark: self._bytes(self._whole([mark])[0]) for mark in (".", ",")}

    def rest(self) -> None:
        """Forget all pieces, as a task ends: an idle worker does not hold memory that others need."""
        self.known, self.former = {}, {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of plain words, encoded as one text and cut where words end."""
        if self.ranks:
            ids = np.array(self.ranks.encode_ordinary(_MARK.join([*words, ""])), self.kind)
        else:
            ids = np.array(self._whole([" ".join(words)])[0], self.kind)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):  # a vocabulary that does not mark them
            return [self._bytes(ids) for ids in self._whole(words)]
        data, width = ids.tobytes(), self.kind.itemsize
        at = [0, *(ends * width).tolist()]
        return [data[lo:hi] for lo, hi in zip(at, at[1:])]

    def _learn(self, pieces: set[bytes]) -> None:
        known, former = self.known, self.former
        new = pieces
        if former:
            known.update((p, former[p]) for p in pieces if p in former)
            new = [p for p in pieces if p not in former]
        bare = [p for p in new if p.isalpha()]  # A-Z only
        if bare:
            known.update(zip(bare, self._words(b" ".join(bare).decode().lower().split(" "))))
        plain, rest = [], []
        for piece in new:
            if not piece.isalpha():
                found = _PLAIN.fullmatch(piece.decode())
                if found:
                    plain.append((piece, *found.groups()))
                else:
                    rest.append(piece)
        if plain:
            ids = self._words([word.lower() for _, word, _ in plain])
            known.update((piece, i + self.marks[mark] if mark else i) for (piece, _, mark), i in zip(plain, ids))
        if rest:
            known.update((p, self._bytes(i)) for p, i in zip(rest, self._whole([p.decode() for p in rest])))

    def _encode(self, words: list[list[bytes]]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, chain.from_iterable(words)))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            flat = list(chain.from_iterable(words))
            self._learn({flat[i] for i in missing})
            for i in missing:
                found[i] = known[flat[i]]
        ends = [0, *accumulate(map(len, words))]
        out = [b"".join(found[a:b]) for a, b in zip(ends, ends[1:])]
        if len(self.known) > KEPT:
            self.former, self.known = self.known, {}
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes; a null text has none."""
        out: list[bytes] = []
        words: list[list[bytes]] = []
        held = 0
        for text in texts:
            data = (text or "").encode()
            if b"<|" not in data:  # special tokens are told by case
                data = _marks_apart(data.lower())  # A-Z only, as bytes; the tokenizer lowers the rest
            if len(data) > CUT:
                out += self._encode(words)
                out.append(b"".join(self._encode([part.split()])[0] for part in cuts(data, CUT)))
                words, held = [], 0
                continue
            words.append(data.split())
            held += len(data)
            if held > CUT:
                out += self._encode(words)
                words, held = [], 0
        return out + self._encode(words)


# What a byte is where marks are set apart: a letter or digit, a mark, white space, or other.
_KIND = bytes(
    46 if c in b".," else 32 if c in b" \t\n\r\x0b\x0c" else 97 if chr(c).isalnum() and c < 128 or c >= 128 else 33 for c in range(256)
)
_LATIN = bytes([*range(128), 0xC3, *range(0x80, 0xC0)])  # bytes of ASCII and of the letters from U+00C0 to U+00FF


def _marks_apart(data: bytes) -> bytes:
    """A space before each ``.`` and ``,`` that white space follows, where that changes no id.

    A mark behind a letter or digit is a word of its own.  Texts with other characters
    than Latin ones, or with a mark behind another sign, stay as they are.
    """
    kinds = data.translate(_KIND)
    if b".. " in kinds or b"!. " in kinds:
        return data
    if not data.isascii() and (data.translate(None, _LATIN) or b"\xc3\x97" in data or b"\xc3\xb7" in data):
        return data
    for mark in (b". ", b", ", b".\n", b",\n"):
        data = data.replace(mark, b" " + mark)
    return data


def cuts(data: bytes, size: int):
    """Slices of about ``size`` bytes that end at white space, so that no word is cut."""
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end]
        start = end


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    return WordTokenizer(path)
