"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..sources.scratch import materialize, temporaries
from .common import tidy, words_of

WINDOW = 10  # words; an item of fewer is one window
# Words of test items in one automaton (about 400 bytes each on every executor).  More
# items become further automata, which the documents pass one after another.
BLOCK_WORDS = 200_000
MAX_COVERAGE = 0.5  # documents with a larger share of hit words are dropped

_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Generalised suffix automaton over word numbers.

    ``go[state * size + word]`` is the next state; ``link`` and ``longest`` are as
    usual.  Each state knows the items in which its strings occur (``items``), so a
    window that ends in a state tells its items without looking at the texts again.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.link, self.longest = [-1], [0]
        nexts: list[dict[int, int]] = [{}]
        numbered = []
        for name, words in items:
            if words:
                numbered.append((name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]))
        self.names = [name for name, _ in numbered]
        pairs = set()
        self.shortest = min((min(window, len(w)) for _, w in numbered), default=window)
        for _, words in numbered:
            last = 0
            for w in words:
                last = self._extend(nexts, last, w)
            pairs.update(zip(words, words[1:]))
        # Items of each state: every prefix marks its state and those above it that hold a window.
        marks: list[set[int] | None] = [None] * len(nexts)
        short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(numbered):
            state = 0
            for w in words:
                state = nexts[state][w]
                up = state
                while self.longest[up] >= window and (marks[up] is None or k not in marks[up]):
                    if marks[up] is None:
                        marks[up] = set()
                    marks[up].add(k)
                    up = self.link[up]
            if len(words) < window:
                short.setdefault(state, []).append((len(words), k))
        self.items = marks
        self.short = short
        self.size = max(1, len(self.vocab))
        self.go = {s * self.size + w: t for s, d in enumerate(nexts) for w, t in d.items()}
        self.pairs = np.array(sorted(a * self.size + b for a, b in pairs), np.int64)

    def _extend(self, nexts: list[dict[int, int]], last: int, w: int) -> int:
        link, longest = self.link, self.longest
        known = nexts[last].get(w)
        if known is not None:
            return known if longest[known] == longest[last] + 1 else self._split(nexts, last, w, known)
        new = len(nexts)
        nexts.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and w not in nexts[p]:
            nexts[p][w] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][w]
            link[new] = q if longest[q] == longest[p] + 1 else self._split(nexts, p, w, q)
        return new

    def _split(self, nexts: list[dict[int, int]], p: int, w: int, q: int) -> int:
        clone = len(nexts)
        nexts.append(dict(nexts[q]))
        self.link.append(self.link[q])
        self.longest.append(self.longest[p] + 1)
        self.link[q] = clone
        while p >= 0 and nexts[p].get(w) == q:
            nexts[p][w] = clone
            p = self.link[p]
        return clone

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word spans [from, to) covered by occurring windows, in order and disjoint, and the items."""
        n = len(words)
        if not n or not self.names:
            return [], set()
        vocab = self.vocab
        ids = np.fromiter((vocab.get(w, -1) for w in words), np.int64, n)
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for lo, hi in self._runs(ids):
            self._stream(ids[lo:hi].tolist(), lo, spans, found)
        return spans, found

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches in which every two neighbours stand side by side in some item.

        A window can only lie within one of them, so the rest need not be streamed.
        """
        known = ids >= 0
        linked = known[:-1] & known[1:]
        at = np.flatnonzero(linked)
        if len(at):
            key = ids[at] * self.size + ids[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, key), max(0, len(self.pairs) - 1))
            linked[at] = (self.pairs[place] == key) if len(self.pairs) else False
        start = np.flatnonzero(known & ~np.r_[False, linked])
        end = np.flatnonzero(known & ~np.r_[linked, False]) + 1
        long = end - start >= self.shortest
        return zip(start[long].tolist(), end[long].tolist())

    def _stream(self, ids: list[int], base: int, spans: list[tuple[int, int]], found: set[int]) -> None:
        go, link, longest, size, window = self.go, self.link, self.longest, self.size, self.window
        state = length = 0
        for i, w in enumerate(ids):
            while state and state * size + w not in go:
                state = link[state]
                length = longest[state]
            to = go.get(state * size + w)
            if to is None:
                state = length = 0
                continue
            state, length = to, length + 1
            hit = 0
            if length >= window:
                hit = window
                s = state  # the state that holds the last ``window`` words
                while longest[link[s]] >= window:
                    s = link[s]
                found |= self.items[s]
            if self.short:
                s = state
                while s > 0:
                    for m, k in self.short.get(s, ()):
                        if m <= length:
                            hit = max(hit, m)
                            found.add(k)
                    s = link[s]
            if hit:
                lo, hi = base + i + 1 - hit, base + i + 1
                while spans and spans[-1][1] >= lo:
                    lo = min(lo, spans.pop()[0])
                spans.append((lo, hi))


def _blocks(items: DataFrame, text: str, key: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items in order, in blocks of at most BLOCK_WORDS words (or one item)."""
    block: list[tuple[object, list[bytes]]] = []
    held = 0
    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).orderBy(F.col("key").cast("string"), "text").toLocalIterator():
        words = words_of(row["text"])
        if block and held + len(words) > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append((row["key"], words))
        held += len(words)
    yield block


_SPANS = ArrayType(StructType().add("lo", "long").add("hi", "long"))
_TEXT = ["th", "th2"]  # what identifies a text between automata: 128 bits


def _found(automaton: Automaton, words: list[bytes], spans: list, items: list) -> tuple[list[dict], list[str]]:
    """Spans and item keys of a text, with those found by earlier automata."""
    s, found = automaton.scan(words)
    names = {str(automaton.names[k]) for k in found if automaton.names[k] is not None}
    if spans:
        s = _joined([*s, *((x["lo"], x["hi"]) for x in spans)])
    return [{"lo": a, "hi": b} for a, b in s], sorted(names.union(items))


def _arrays(spans: list, items: list) -> list[pa.Array]:
    return [pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))), pa.array(items, pa.list_(pa.string()))]


def _hits(docs: DataFrame, text: str, shared: Broadcast) -> DataFrame:
    """(th, th2, spans, items) of the distinct texts that one automaton finds something in."""
    rows = docs.select(*_text_keys(text), F.col(text).alias("t"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [_found(shared.value, words_of(t.as_py()), [], []) for t in batch.column("t")]
            at = [i for i, (spans, _) in enumerate(found) if spans]
            if at:
                keys = [batch.column(c).take(pa.array(at)) for c in _TEXT]
                yield pa.RecordBatch.from_arrays([*keys, *_arrays(*zip(*[found[i] for i in at]))], names=[*_TEXT, "spans", "items"])

    schema = StructType().add("th", "long").add("th2", "long").add("spans", _SPANS).add("items", ArrayType(StringType()))
    return rows.mapInArrow(tidy(run), schema).dropDuplicates(_TEXT)


def _text_keys(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("th"), F.xxhash64(F.lit("second"), text).alias("th2")]


def _scan(docs: DataFrame, text: str, shared: Broadcast, earlier: DataFrame | None) -> DataFrame:
    """(doc struct, n_words, spans, items) per row of ``docs``, with what earlier automata have found."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"))
    joined = earlier is not None
    if joined:
        rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"), *_text_keys(text)).join(earlier, _TEXT, "left").drop(*_TEXT)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            n_words, spans, items = [], [], []
            old = [batch.column(c).to_pylist() for c in ("spans", "items")] if joined else None
            for i, text in enumerate(batch.column("t")):
                words = words_of(text.as_py())
                s, names = _found(shared.value, words, *((old[0][i] or [], old[1][i] or []) if old else ([], [])))
                n_words.append(len(words))
                spans.append(s)
                items.append(names)
            columns = [batch.column("doc"), pa.array(n_words, pa.int64()), *_arrays(spans, items)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "spans", "items"])

    schema = StructType([rows.schema["doc"]]).add("n_words", "long")
    return rows.mapInArrow(tidy(run), schema.add("spans", _SPANS).add("items", ArrayType(StringType())))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """(doc, n_words, spans, items) per row of ``docs``; doc is the whole row as a struct.

    Training words are streamed through the automaton; where the longest match reaches
    ``window`` words (or the whole of a shorter item) the words under it are hit.
    ``spans`` are disjoint word ranges [lo, hi), ``items`` the sorted keys (as text)
    of the items that occur.  One narrow pass, no shuffle, for items of up to
    BLOCK_WORDS words.  More items take one more pass over the text column for each
    further automaton, which keeps only the spans of texts it finds something in; the
    last pass joins them.

    Nulls: null texts have no words; items with a null key hit words but are not named.
    Empty texts have no words either; very long ones are streamed.  Repeated rows and
    items count as they stand.  Without items nothing is hit; an empty table gives no
    rows.  Extra columns travel inside ``doc``, so no name can clash.
    """
    share = docs.sparkSession.sparkContext.broadcast
    with temporaries(docs.sparkSession):
        automaton, earlier = None, None
        for block in _blocks(items, item_text, item_key):
            if automaton is not None:  # there is a further one: what this one finds is kept by text
                shared = share(automaton)
                found = materialize(_hits(docs, text, shared), "decontaminate-hits")
                shared.unpersist()
                earlier = found if earlier is None else earlier.union(found)
            automaton = Automaton(block, window)
        if earlier is not None:
            spans = F.flatten(F.collect_list("spans")).alias("spans")
            items_of = F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
            earlier = materialize(earlier.groupBy(*_TEXT).agg(spans, items_of), "decontaminate-earlier", keep=True)
    return _scan(docs, text, share(automaton), earlier)


def without_spans(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not spans or text is None:
        return text
    data = text.encode()
    at = [m.span() for m in _SPAN.finditer(data)]
    out, done = [], 0
    for s in spans:
        lo, hi = at[s["lo"]][0], at[s["hi"] - 1][1]
        out.append(data[done:lo])
        done = hi
    out.append(data[done:])
    return b"".join(out).decode()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``docs`` with the columns it has, without benchmark passages.

    Hit spans are cut out of the text; a row whose hit words are more than
    ``max_coverage`` of all is dropped.  Everything else stays as it is: null, empty and
    clean texts, repeated rows, extra columns.  Very long texts are cut as others; an
    empty table gives no rows.
    """
    found = matches(docs, items, text, item_text, item_key, window)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    clean = found.filter(hits <= F.col("n_words") * max_coverage)
    inner = clean.select("doc", F.col("doc")[text].alias("t"), "spans")

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = [without_spans(t.as_py(), s.as_py()) for t, s in zip(batch.column("t"), batch.column("spans"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "t"])

    done = inner.mapInArrow(tidy(cut), StructType([inner.schema["doc"]]).add("t", "string"))
    return done.select(*[F.col("t").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
