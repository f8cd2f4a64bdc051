"""Licence scans: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import words_of
from .license_texts import TEMPLATES

LEAST = 0.8  # Dice coefficient from which a text counts as the template
# Templates go to every executor, which their size bounds: more than this many
# characters are refused, for the caller to scan in several sets.
MOST_TEMPLATE_CHARS = 4_000_000
_FIELDS = ["license", "score", "unit", "first_line", "last_line"]


def bigrams(words: list[bytes]) -> Counter:
    """Pairs of neighbours with their counts; a single word is paired with nothing."""
    return Counter(zip(words, words[1:])) if len(words) != 1 else Counter([(words[0], b"")])


class Templates:
    def __init__(self, texts: list[tuple[str, str]], least: float):
        self.least = least
        rows = sorted((sum(b.values()), name, b) for name, b in ((name, bigrams(words_of(t))) for name, t in texts) if b)
        self.sizes = [n for n, _, _ in rows]
        self.names = [name for _, name, _ in rows]
        self.counts = [b for _, _, b in rows]
        self.index: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
        for k, (_, _, b) in enumerate(rows):
            for pair, n in b.items():
                self.index.setdefault(pair, []).append((k, n))
        # 2 * common / (a + b) >= t needs sizes within a factor t / (2 - t) of each other.
        self.ratio = least / (2 - least)
        self.allowed = [(n * self.ratio, n / self.ratio) for n in self.sizes]

    def best(self, words: list[bytes]) -> tuple[str, float] | None:
        """The nearest template of at least ``least``; of equal ones the first by size, then name."""
        n = max(1, len(words) - 1) if words else 0
        lo, hi = bisect_left(self.sizes, n * self.ratio), bisect_right(self.sizes, n / self.ratio)
        if not n or lo >= hi:
            return None
        common: dict[int, int] = {}
        for pair, times in bigrams(words).items():
            for k, m in self.index.get(pair, ()):
                if lo <= k < hi:
                    common[k] = common.get(k, 0) + min(times, m)
        scored = [(2 * c / (n + self.sizes[k]), -k) for k, c in common.items()]
        top = max(scored, default=(0.0, 0))
        return (self.names[-top[1]], top[0]) if top[0] >= self.least else None

    def scan(self, text: str | None) -> list[tuple[str, float, str, int, int]]:
        """Matches of lines, of blocks of lines between empty ones, of the whole text, and of windows of words.

        A window that lies in a better or equal match of another unit is left out.
        """
        lines = [words_of(line) for line in (text or "").split("\n")]
        units: list[tuple[str, int, int]] = [("line", i, i) for i, w in enumerate(lines) if w]
        start = None
        blocks = []
        for i, w in enumerate([*lines, []]):
            if w and start is None:
                start = i
            elif not w and start is not None:
                blocks.append((start, i - 1))
                start = None
        units += [("block", a, b) for a, b in blocks if b > a]
        if len(blocks) > 1:
            units.append(("text", blocks[0][0], blocks[-1][1]))
        largest = self.allowed[-1][1] if self.allowed else 0
        out = []
        for unit, a, b in units:
            if sum(map(len, lines[a : b + 1])) - 1 <= largest:
                found = self.best([w for line in lines[a : b + 1] for w in line])
                if found:
                    out.append((*found, unit, a, b))
        words = [w for line in lines for w in line]
        of_line = [i for i, line in enumerate(lines) for _ in line]
        for name, score, lo, hi in self.windows(words):
            a, b = of_line[lo], of_line[hi]
            if not any(x <= a and b <= y and held >= score for _, held, _, x, y in out):
                out.append((name, score, "window", a, b))
        return out

    def windows(self, words: list[bytes]) -> list[tuple[str, float, int, int]]:
        """(name, score, first word, last word) of runs of words like a template, none overlapping.

        The best run starts and ends at a bigram of its template, or cutting the end
        would raise its score.  Its size is within the bounds, and ``ratio`` of the
        template's bigrams are in it, so few starts are followed.
        """
        hits: dict[int, list[int]] = {}
        pairs = list(zip(words, words[1:]))
        for at, pair in enumerate(pairs):
            for k, _ in self.index.get(pair, ()):
                hits.setdefault(k, []).append(at)
        found = []
        for k, places in hits.items():
            size, (least, most) = self.sizes[k], self.allowed[k]
            need = math.ceil(least - 1e-9)
            for i, start in enumerate(places[: max(0, len(places) - need + 1)]):
                if places[i + need - 1] - start + 1 > most:
                    continue
                common, seen, best = 0, {}, None
                for end in places[i : bisect_right(places, start + most - 1)]:
                    pair = pairs[end]
                    seen[pair] = seen.get(pair, 0) + 1
                    common += seen[pair] <= self.counts[k][pair]
                    score = 2 * common / (end - start + 1 + size)
                    if score >= self.least and (best is None or score > best[0]):
                        best = score, end, common
                if best:
                    score, end, common = best
                    # Of overlapping runs the one that explains most words goes first.
                    found.append((common - (end - start + 1 + size) / 4, score, -start, self.names[k], end))
        out, taken = [], bytearray(len(words))
        for _, score, start, name, end in sorted(found, reverse=True):
            if not any(taken[-start : end + 2]):
                taken[-start : end + 2] = b"\1" * (end + 2 + start)
                out.append((name, score, -start, end + 1))
        return sorted(out, key=lambda m: m[2])


def scan_licenses(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, text: str = "text", least: float = LEAST
) -> DataFrame:
    """(doc, matches) per row of ``docs``: the row as a struct and its licence notices.

    A match is (license, score, unit, first_line, last_line), lines from 0: the best
    template of a line, of a block of lines between empty ones, of the whole text, or of
    a window of words anywhere (a notice of several paragraphs, or inside a line).
    Texts are compared as lower-cased words, so punctuation and white space do not
    matter.  Size bounds leave few templates to compare, and an index from bigrams to
    templates counts what is shared.  One narrow pass.

    Null and empty texts have no matches, nor does a set without templates.  Repeated
    rows get equal results; extra columns travel inside ``doc``.
    """
    texts = TEMPLATES if templates is None else templates
    if sum(len(t) for _, t in texts) > MOST_TEMPLATE_CHARS:
        raise ValueError(f"more than {MOST_TEMPLATE_CHARS} characters of templates")
    shared = docs.sparkSession.sparkContext.broadcast(Templates(texts, least))
    kind = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("unit", pa.string()), ("first_line", pa.int32()), ("last_line", pa.int32())]))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in source:
            found = [[dict(zip(_FIELDS, m)) for m in known.scan(t.as_py())] for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, kind)], names=["doc", "matches"])

    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"))
    match = StructType().add("license", "string").add("score", "double").add("unit", "string")
    match = match.add("first_line", "integer").add("last_line", "integer")
    return rows.mapInArrow(run, StructType([rows.schema["doc"]]).add("matches", ArrayType(match)))
