"""Which tokens of two tokenizers end together, and how often over a corpus.

The first pass counts, per task, the pairs of ids that end at the same byte.  The
distinct pairs get a minimal perfect hash; every task's counts become a dense vector
indexed by it, and a tree of fixed fan sums the vectors.  The second pass aligns the
documents again and looks the counts up; a key stored beside each count verifies it.

Of two tokens that end together the bytes of the shorter end the longer one.  So there
are at most as many distinct pairs as the tokens of both vocabularies have bytes, some
hundred thousand, whatever the corpus: what is broadcast is bounded by that.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporaries
from .common import groups_of
from .tokens import SPELT

CHUNK = 1 << 14  # counts of a row of a dense vector
FAN = 16  # vectors summed at once
SLICE = 1 << 15  # characters encoded at once
LONG = 1_000  # characters of a stretch that is encoded alone
KEPT = 500_000  # stretches a worker remembers
KEPT_CHARS = 16 << 20  # and their characters
CUT = 1 << 20  # characters of a long text in hand at once
# One space between other characters starts a token in both vocabularies: text is
# aligned from there to the next such space, each distinct stretch once.
_BORDER = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: where byte-level vocabularies of this kind cut text before merging.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- minimal perfect hash -------------------------------------------------------------


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct longs to 0 .. n - 1, about four bits a key, by levels of bits.

    On each level a key that hashes to a slot alone sets its bit and is done; the
    others go on to the next.  A key's number is the rank of its bit.  ``keys`` holds
    the key of each number, so a long that was not among them is told from one that was.
    """

    def __init__(self, keys: np.ndarray):
        rest, parts, self.starts, at = np.unique(keys.astype(np.int64)), [], [], 0
        self.n = len(rest)
        every = rest
        while len(rest):
            size = -(-2 * len(rest) // 64) * 64
            slot = (_mix(rest, len(parts)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            self.starts.append((at, size))
            at += size
            rest = rest[~alone[slot]]
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words).astype(np.int64))]
        self.keys = np.zeros(self.n, np.int64)
        self.keys[self._number(every)] = every

    def _number(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(self.starts):
            place = start + (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            on = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[on]] = (self.before[place >> 6] + below)[on]
            left = left[~on]
            if not len(left):
                break
        return out

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those that are not in the set."""
        out = self._number(keys)
        if self.n:
            out[self.keys[out] != keys] = -1
        return out


# --- tokens of stretches of text ------------------------------------------------------


def _by_rank(path: str, bytes_of: list[bytes]):
    """The byte-level vocabulary as ranks, if its merges stand in the order of their ids; else None.

    The same ids several times faster, for text without very long words.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") or not isinstance(before, dict) or any(before.get(k) != v for k, v in plain.items()):
        return None
    merged = [("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    size = 256 + len(merged)  # single bytes, then one token per merge
    if [model["vocab"].get(m) for m in merged] != list(range(256, size)) or {len(x) for x in bytes_of[:256]} != {1}:
        return None
    ranks = {bytes_of[i]: i for i in range(size)}
    if len(ranks) != size:
        return None
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers, and what is known of the stretches seen last."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already uses every core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        spelt = self.a.get_vocab()
        self.bytes_a = [b""] * (max(spelt.values()) + 1)
        for token, i in spelt.items():
            self.bytes_a[i] = bytes(SPELT[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.ranks = _by_rank(a_path, self.bytes_a)
        # A piece with a space behind another character could span a border.
        self.joins = not any(re.search("[^▁]▁", p) for p in pieces)
        self.split = _BORDER.split if self.joins else lambda t: [t]
        self.counts: tuple | None = None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.spelt = np.zeros(1024, bool)  # whether the bytes of the tokens are those of the text
        self.sizes = np.zeros((1024, 6), np.int64)  # tokens of a, of b, links, best links, sum of counts, links not met before
        self.pairs: list[np.ndarray] = []  # of all stretches, in their order; kept in the first pass only

    def full(self) -> bool:
        return len(self.known) > KEPT or self.chars > KEPT_CHARS

    def look(self, counts: tuple | None) -> None:
        """Count links by (hash, counts, is best) from now on; None: do not."""
        if counts is not self.counts:
            self.counts = counts
            self.forget()

    def rows(self, stretches: list[str]) -> np.ndarray:
        """The row of each stretch; new ones are aligned."""
        known = self.known
        new = list(set(stretches).difference(known))
        while len(self.spelt) < len(known) + len(new):
            self.spelt = np.concatenate([self.spelt, np.zeros_like(self.spelt)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        # Stretches that begin and end with other characters are encoded joined by
        # spaces, at each of which a token starts; long ones alone.
        plain, odd = [], []
        for s in new:
            (plain if s.strip() == s and self.joins and len(s) <= LONG else odd).append(s)
        open_ = [*([s] for s in odd), *_slices(plain)]
        while open_:  # those that are not spelt are found by halves
            part = open_.pop()
            if not self._learn(part):
                open_ += [part[: len(part) // 2], part[len(part) // 2 :]]
        return np.fromiter(map(known.__getitem__, stretches), np.int64, len(stretches))

    def _learn(self, new: list[str]) -> bool:
        """Align stretches as one text; False, and nothing learnt, where the tokens of several do not spell it."""
        text = " ".join(new)
        data = (" " + text).encode()
        if self.ranks and len(text) <= SLICE + LONG:
            a = self.ranks.encode_ordinary(" " + text)
        else:
            a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        whole = b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b])
        if not whole:
            if len(new) > 1:
                return False
            a, b = [], []
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        cuts = np.cumsum([len(s.encode()) + 1 for s in new])
        ends = np.searchsorted(end_a[at_a], cuts, side="right") if whole else np.zeros(1, np.int64)
        pairs = a[at_a] * len(self.bytes_b) + b[at_b]
        first = len(self.known)
        rows = slice(first, first + len(new))
        sizes = self.sizes[rows]
        for k, end in ((0, end_a), (1, end_b)):
            sizes[:, k] = np.diff(np.searchsorted(end, cuts, side="right"), prepend=0)
        sizes[:, 2] = np.diff(ends, prepend=0)
        self.spelt[rows] = whole
        if self.counts:
            hashed, counts, best = self.counts
            at = hashed.number(pairs)
            missing = at < 0  # stretches of texts without tokens may have pairs that no other text has
            of_best, of_counts = (np.where(missing, 0, v[at]) if len(v) else at * 0 for v in (best, counts))
            sums = np.c_[of_best, of_counts, missing].cumsum(axis=0, dtype=np.int64)
            sizes[:, 3:] = np.diff(np.r_[np.zeros((1, 3), np.int64), sums][ends], axis=0, prepend=0)
            text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            cut_a, cut_b = [0, *(at_a + 1).tolist()], [0, *(at_b + 1).tolist()]
            each = [
                f"{text_a[i]}|{text_b[k]}" if j - i == 1 == m - k else ",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m])
                for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])
            ]
            self.groups += [";".join(each[lo:hi]) for lo, hi in zip([0, *ends.tolist()], ends.tolist())]
        else:
            self.pairs.append(pairs)
        self.known.update(zip(new, range(first, first + len(new))))
        self.chars += len(text)
        return True

    def parts(self, text: str) -> Iterator[list[str]]:
        """Stretches of a text, about CUT characters at once; joined by spaces they are the text."""
        start = 0
        while len(text) - start > 2 * CUT:
            border = _BORDER.search(text, start + CUT) if self.joins else None
            if not border:
                break
            yield self.split(text[start : border.start()])
            start = border.end()
        yield self.split(text[start:] if start else text)


def _slices(stretches: list[str]) -> Iterator[list[str]]:
    """Runs of stretches of together about SLICE characters."""
    start, held = 0, 0
    for i, s in enumerate(stretches):
        held += len(s) + 1
        if held >= SLICE:
            yield stretches[start : i + 1]
            start, held = i + 1, 0
    if start < len(stretches):
        yield stretches[start:]


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(a_path, b_path)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    texts = batch.column("t").to_pylist()
    for lo, hi in groups_of(texts, CUT):
        yield lo, hi, [t or "" for t in texts[lo:hi]]


# --- passes ---------------------------------------------------------------------------


def _task_counts(source: Iterator[pa.RecordBatch], both: Aligner) -> Iterator[pa.RecordBatch]:
    """The links of a task by pair."""
    both.look(None)
    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    hits = np.zeros(len(both.known), np.int64)

    def gather() -> None:
        """Links of the stretches hit so far."""
        nonlocal pairs, counts, hits
        weight = np.repeat(hits, both.sizes[: len(hits), 2])
        pairs, at = np.unique(np.concatenate([pairs, *both.pairs]), return_inverse=True)
        summed = np.zeros(len(pairs), np.int64)
        np.add.at(summed, at, np.r_[counts, weight])
        pairs, counts = pairs[summed > 0], summed[summed > 0]
        hits = np.zeros(len(both.known), np.int64)

    def hit(rows: np.ndarray) -> None:
        nonlocal hits
        more = np.bincount(rows, minlength=len(both.known))
        more[: len(hits)] += hits
        hits = more
        if both.full():
            gather()
            both.forget()
            hits = np.zeros(0, np.int64)

    for batch in source:
        for _, _, texts in _texts(batch):
            split = []
            for text in texts:
                if len(text) <= 2 * CUT:
                    if text:
                        split.append(both.split(text))
                    continue
                whole = True  # a long text is read twice: whether it counts is known at its end
                for part in both.parts(text):
                    at = both.rows(part)
                    whole = bool(both.spelt[at].all()) and whole
                    hit(np.zeros(0, np.int64))
                for part in both.parts(text) if whole else ():
                    hit(both.rows(part))
            rows = both.rows([s for words in split for s in words])
            if not both.spelt[rows].all():
                ends = np.cumsum([len(words) for words in split])
                clean = np.logical_and.reduceat(both.spelt[rows], np.r_[0, ends[:-1]])
                rows = rows[np.repeat(clean, np.diff(np.r_[0, ends]))]
            hit(rows)
    gather()
    for lo in range(0, len(pairs), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[lo : lo + 100_000]), pa.array(counts[lo : lo + 100_000])], names=["pair", "n"])


def _summed(rows: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.int64)
    for data in rows["counts"]:
        total += np.frombuffer(data.as_buffer(), "<i8")
    return rows.slice(0, 1).set_column(rows.schema.get_field_index("counts"), "counts", pa.array([total.tobytes()], pa.binary()))


def corpus_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> tuple[PerfectHash, np.ndarray]:
    """The hash of all distinct pairs of ``docs`` and the count of each by its number."""
    with temporaries(docs.sparkSession):
        return _corpus_counts(docs, a_path, b_path, text)


def _corpus_counts(docs: DataFrame, a_path: str, b_path: str, text: str) -> tuple[PerfectHash, np.ndarray]:
    spark = docs.sparkSession
    given = docs.select(F.col(text).alias("t"))
    counted = materialize(
        given.mapInArrow(lambda source: _task_counts(source, aligner(a_path, b_path)), "pair long, n long"), "pair-counts"
    )
    hashed = PerfectHash(counted.select("pair").distinct().toArrow()["pair"].to_numpy())  # bounded by the vocabularies
    if not hashed.n:
        return hashed, np.zeros(0, np.int64)
    shared = spark.sparkContext.broadcast(hashed)

    def dense(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = shared.value, None
        for batch in source:
            if total is None:
                total = np.zeros(-(-hashed.n // CHUNK) * CHUNK, np.int64)
            at = hashed.number(batch.column("pair").to_numpy())
            if (at < 0).any():
                raise RuntimeError("a counted pair is not among the distinct ones")
            np.add.at(total, at, batch.column("n").to_numpy())
        if total is not None:
            part = TaskContext.get().partitionId()
            for k, lo in enumerate(range(0, len(total), CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([part], pa.int64()), pa.array([total[lo : lo + CHUNK].tobytes()], pa.binary())],
                    names=["chunk", "part", "counts"],
                )

    schema = "chunk int, part long, counts binary"
    vectors = materialize(counted.mapInArrow(dense, schema), "pair-vectors")
    parts = vectors.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        parts = -(-parts // FAN)
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("chunk", "part").applyInArrow(_summed, schema)
    held = vectors.toArrow().sort_by("chunk")["counts"]
    return hashed, np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in held])[: hashed.n]


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(a, b, n): ids that end together somewhere in ``docs``, and how often; rows as ``align`` counts them."""
    hashed, counts = corpus_counts(docs, a_path, b_path, text)
    width = len(aligner(a_path, b_path).bytes_b)
    table = pa.table({"a": hashed.keys // width, "b": hashed.keys % width, "n": counts})
    return docs.sparkSession.createDataFrame(table)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(doc, n_a, n_b, n_links, n_best, count_sum, groups) per row of ``docs``.

    ``a_path``: a byte-level vocabulary of tokenizers, ``b_path``: a sentencepiece model
    that puts a space before a text; both see space + text.  Bytes where tokens of both
    end cut the text into groups, ``groups`` writes them as ``a1,a2|b1;a3|b2,b3``.  The
    last tokens of a group end together and are its link.  The count of a link is how
    many links of all ``docs`` have its pair of ids, ``count_sum`` the sum over the
    row's links; ``n_best`` says how many links have the highest count of their b id.

    Null and empty texts and texts whose tokens do not spell space + text have no tokens:
    zeros and empty ``groups``, and no part in any count.  Repeated rows count and are
    returned as often as they come; an empty table gives no rows; ``doc`` is the row as
    a struct, so no name can clash.  Long texts are taken in parts; only a stretch
    without a single space is encoded at once.
    """
    hashed, counts = corpus_counts(docs, a_path, b_path, text)
    width = len(aligner(a_path, b_path).bytes_b)
    highest = np.zeros(width, np.int64)
    np.maximum.at(highest, hashed.keys % width, counts)
    shared = docs.sparkSession.sparkContext.broadcast((hashed, counts, counts == highest[hashed.keys % width]))
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"))
    schema = rows.select("doc").schema
    names = ["n_a", "n_b", "n_links", "n_best", "count_sum"]
    for name in names:
        schema = schema.add(name, "long")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        both.look(shared.value)

        def take(at: np.ndarray, i: int, sums: np.ndarray, groups: list[str]) -> None:
            """Add stretches to text i; one that is not spelt leaves the text without tokens."""
            sums[i, :6] += both.sizes[at].sum(axis=0)
            sums[i, 6] += np.count_nonzero(~both.spelt[at])
            more = ";".join([both.groups[k] for k in at.tolist()])
            groups[i] = "" if sums[i, 6] else f"{groups[i]};{more}" if groups[i] else more

        for batch in source:
            for lo, hi, texts in _texts(batch):
                sums, groups = np.zeros((len(texts), 7), np.int64), [""] * len(texts)  # at last: stretches not spelt
                short = [i for i, t in enumerate(texts) if 0 < len(t) <= 2 * CUT]
                split = [both.split(texts[i]) for i in short]
                at = both.rows([s for words in split for s in words])
                ends = np.cumsum([0, *map(len, split)])
                for k, i in enumerate(short):
                    take(at[ends[k] : ends[k + 1]], i, sums, groups)
                if both.full():
                    both.forget()
                for i in (i for i, t in enumerate(texts) if len(t) > 2 * CUT):
                    for part in both.parts(texts[i]):
                        take(both.rows(part), i, sums, groups)
                        if both.full():
                            both.forget()
                if sums[sums[:, 6] == 0, 5].any():
                    raise RuntimeError("a pair of the second pass was not met in the first")
                sums[sums[:, 6] > 0] = 0
                columns = [batch.column("doc").slice(lo, hi - lo), *(pa.array(c) for c in sums[:, :5].T.copy()), pa.array(groups, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", *names, "groups"])

    return rows.mapInArrow(run, schema.add("groups", "string"))
