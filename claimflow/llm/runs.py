"""Periodic runs of words: at dyadic scales, blocks are located in the windows behind them.

A run repeats a stretch of q words four times or more.  At scale B every aligned block
of B words is compared with the 2B words behind it, for all distances of B to 2B - 1 at
once: the sum of squared differences comes from exact number-theoretic transforms and is
zero only where block and window agree.  Such distances are seeds; a seed grows to the
longest stretch with that period.  A run of period q in [B, 2B) spans at least 4B words,
so it holds whole blocks of B, and the block behind each at distance q.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import groups_of

LEAST_LENGTH = 6  # words
LEAST_TIMES = 4  # periods
GROUP_CHARS = 1_000_000  # texts of together so many characters are searched as one
_RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))
_CELLS = 1 << 20  # numbers of a transform in hand at once
# Primes p with a primitive root g and the power of two that divides p - 1.
PRIMES = [(2013265921, 31, 27), (469762049, 3, 26), (167772161, 3, 25)]


def _roots(p: int, g: int, size: int) -> np.ndarray:
    """The powers 0 to size/2 - 1 of a root of unity of that order, by doubling."""
    w, out = pow(g, (p - 1) // size, p), np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * np.uint64(pow(w, len(out), p)) % np.uint64(p)])
    return out


def _transform(a: np.ndarray, p: int, roots: np.ndarray) -> np.ndarray:
    """Transform of each row (a power of two long), in bit-reversed order."""
    rows, size = a.shape
    mod, half = np.uint64(p), size // 2
    a = a.copy()
    while half:
        v = a.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        total, gap = low + high, (low + (mod - high)) * roots[:: size // (2 * half)][:half] % mod
        v[:, :, 0], v[:, :, 1] = np.where(total >= mod, total - mod, total), gap
        half //= 2
    return a


def _inverse(a: np.ndarray, p: int, back: np.ndarray) -> np.ndarray:
    """Rows back from bit-reversed order; ``back``: powers of the inverse root."""
    rows, size = a.shape
    mod, half = np.uint64(p), 1
    a = a.copy()
    while half < size:
        v = a.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0].copy(), v[:, :, 1] * back[:: size // (2 * half)][:half] % mod
        total, gap = low + high, low + (mod - high)
        v[:, :, 0], v[:, :, 1] = np.where(total >= mod, total - mod, total), np.where(gap >= mod, gap - mod, gap)
        half *= 2
    return a * np.uint64(pow(size, -1, p)) % mod


def zero_distances(x: np.ndarray, block: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) where x[b : b + size] stands again at that distance, in [size, 2 size).

    ``x`` holds numbers below 2**31; blocks start at multiples of ``size`` and may lack
    part of their window behind the end, where nothing agrees.  The sum of squared
    differences is known modulo so many primes that it is zero only if it is zero
    modulo each of them.
    """
    most = size * max(1, int(x.max())) ** 2 if len(x) else 0
    primes, bound = [], 1
    for p, g, twos in PRIMES:
        if bound > most:
            break
        if 2 * size <= 1 << twos:
            primes.append((p, g))
            bound *= p
    if bound <= most:
        raise ValueError("a text of this length needs further primes")
    roots = [(_roots(p, g, 2 * size), _roots(p, pow(g, -1, p), 2 * size)) for p, g in primes]
    at, far = [], []
    step = max(1, _CELLS // (2 * size))
    for lo in range(0, len(block), step):
        b = block[lo : lo + step]
        places = b[:, None] + size + np.arange(2 * size)
        window = x[np.minimum(places, len(x) - 1)].astype(np.uint64)
        agree = np.broadcast_to(b[:, None] + 2 * size + np.arange(size) <= len(x), (len(b), size)).copy()
        own = np.zeros((len(b), 2 * size), np.uint64)
        own[:, :size] = x[b[:, None] + np.arange(size)][:, ::-1]
        for (p, _), (ahead, back) in zip(primes, roots):
            mod = np.uint64(p)
            y, z = window % mod, own % mod
            product = _inverse(_transform(y, p, ahead) * _transform(z, p, ahead) % mod, p, back)[:, size - 1 : 2 * size - 1]
            squares = np.concatenate([np.zeros((len(b), 1), np.uint64), np.cumsum(y * y % mod, axis=1)], axis=1)
            theirs = squares[:, size : 2 * size] - squares[:, :size]  # sums below 2 size p, no wrap
            ours = (z * z % mod).sum(axis=1, dtype=np.uint64)[:, None]
            agree &= (theirs + ours) % mod == (product + product) % mod
        i, d = np.nonzero(agree)
        at.append(b[i])
        far.append(d + size)
    return (np.concatenate(at), np.concatenate(far)) if at else (np.array([], np.int64), np.array([], np.int64))


def _same(x: np.ndarray, i: int, d: int, step: int) -> int:
    """How many words from i on, in the direction of ``step``, equal those d words later."""
    count, size = 0, 64
    while True:
        n = min(size, (len(x) - d - (i + count)) if step > 0 else i - count + 1)
        if n <= 0:
            return count
        a = i + count if step > 0 else i - count - n + 1
        differ = x[a : a + n] != x[a + d : a + d + n]
        if differ.any():
            return count + (int(differ.argmax()) if step > 0 else int(differ[::-1].argmax()))
        count, size = count + n, 2 * size


def runs(x: np.ndarray, longest: int, least: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``x``, by start, then period.

    A run is a stretch with smallest period q, at least ``least`` and ``times`` q words
    long (``times`` 4 or more), that no neighbour extends.  ``longest``: a bound on the
    length of any run, such as that of the longest of several texts joined.
    """
    n, found = len(x), []
    if n < 2:
        return found
    order = np.argsort(x, kind="stable")
    again = np.full(n, n, np.int64)  # distance to the next place of the same word
    same = x[order[1:]] == x[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    size = 1
    while times * size <= longest:
        # A block that recurs has no word whose next place is 2 size or farther: exact and cheap.
        starts = np.arange(0, n - 2 * size + 1, size)
        if not len(starts):
            break
        near = np.maximum.reduceat(again[: starts[-1] + size], starts) < 2 * size
        at, far = zero_distances(x, starts[near], size)
        # Seeds inside runs already known whose period divides the distance say nothing new.
        new = np.ones(len(at), bool)
        for s, length, q in found:
            if length >= 2 * size:
                lo, hi = np.searchsorted(at, (s, s + length))
                new[lo:hi] &= (far[lo:hi] % q != 0) | (at[lo:hi] + far[lo:hi] + size > s + length)
        at, far = at[new], far[new]
        last_d, last_end = -1, -1
        for k in np.lexsort((at, far)).tolist():
            i, d = int(at[k]), int(far[k])
            if d == last_d and i + d + size <= last_end:
                continue
            start = i - _same(x, i - 1, d, -1)
            end = i + size + _same(x, i + size, d, 1) + d
            last_d, last_end = d, end
            if end - start >= max(least, times * d):
                found.append((start, end - start, d))
        size *= 2
    return sorted((s, length, q) for s, length, q in found)


def collapsed(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run holds behind its first period."""
    keep = np.ones(n, bool)
    for start, length, q in found:
        keep[start + q : start + length] = False
    return keep


def _joined(texts: list[str | None]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text, found in all of them joined by numbers that stand once."""
    split = [(t or "").encode().split() for t in texts]  # white space of bytes: the six ASCII ones
    sizes = np.array([len(w) for w in split])
    number: dict[bytes, int] = {}
    put = number.setdefault
    parts = []
    for words in split:
        parts.append(np.fromiter((put(w, len(number)) for w in words), np.int64, len(words)))
    first = np.cumsum(sizes + 1) - sizes - 1
    x = np.empty(int(sizes.sum()) + len(split), np.int64)
    for k, (s, part) in enumerate(zip(first.tolist(), parts)):
        x[s : s + len(part)] = part
        x[s + len(part)] = len(number) + k
    found = runs(x, int(sizes.max(initial=0)))
    owner = np.searchsorted(first, [s for s, _, _ in found], side="right") - 1
    of: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for k, (s, length, q) in zip(owner.tolist(), found):
        of[k].append((s - int(first[k]), length, q))
    yield from zip(split, of)


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, n_words, runs, collapsed) per row of ``docs``.

    ``doc`` is the row as a struct, so no name can clash; runs are (start, length,
    period) in words, by start, then period; ``collapsed`` is the text with one period
    of each run left, words joined by one space.  Words are separated by ASCII white
    space and compared as they are.

    Null and empty texts and those without words have no runs and an empty
    ``collapsed``.  Repeated rows are returned as often as they come; an empty table
    gives no rows.  A long text is searched alone; a task holds some numbers per word
    of it.  Texts of more than 100 million words raise an error: the transforms
    need further primes there.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column("t").to_pylist()
            for lo, hi in groups_of(texts, GROUP_CHARS):
                n, all_runs, rest = [], [], []
                for words, found in _joined(texts[lo:hi]):
                    n.append(len(words))
                    all_runs.append([{"start": s, "length": length, "period": q} for s, length, q in found])
                    if found:
                        words = [words[i] for i in np.flatnonzero(collapsed(len(words), found)).tolist()]
                    rest.append(b" ".join(words).decode())
                columns = [batch.column("doc").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(all_runs, kind), pa.array(rest, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "runs", "collapsed"])

    schema = rows.select("doc").schema.add("n_words", "long").add("runs", _RUNS).add("collapsed", "string")
    return rows.mapInArrow(run, schema)
