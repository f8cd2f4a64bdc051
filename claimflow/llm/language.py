"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import groups_of, tidy

UNKNOWN = "und"
BUCKETS_LOG2 = 16  # the matrix has labels x 65,536 cells
ORDERS = (1, 2, 3)  # lengths of the n-grams
SMOOTHING = 0.5
# Labelled rows drawn per label to fit on, by a hash of their key; the only sample
# taken.  Languages are told from a few hundred texts; scoring reads every text.
FIT_ROWS_PER_LABEL = 5_000
MOST_LABELS = 1_024  # bounds what the driver collects and broadcasts: 256 MB


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    log_prob: np.ndarray  # float32 [labels, buckets]
    log_prior: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _codes(text: str, after_space: bool) -> np.ndarray:
    """Code points in lower case, each run of other characters than letters as one space."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    letter = _letters()[a]
    before = np.empty_like(letter)
    before[:1] = not after_space
    before[1:] = letter[:-1]
    return np.where(letter, a, np.uint64(32))[letter | before]


def _grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, index of the text) of all n-grams, in blocks of bounded size."""
    block = 300_000
    for lo, hi in groups_of(texts, block):
        long = hi - lo == 1 and len(texts[lo] or "") > block
        parts = [texts[lo][k : k + block] for k in range(0, len(texts[lo]), block)] if long else None
        carry = np.array([32], np.uint64)  # a text begins after a space
        for part in parts or [None]:
            if part is None:
                each = [np.r_[carry, _codes(t or "", True)] for t in texts[lo:hi]]
                codes = np.concatenate(each)
                owner = np.repeat(np.arange(lo, hi), [len(e) for e in each])
                fresh = 0
            else:
                codes = np.r_[carry, _codes(part, carry[-1] == 32)]
                owner = np.full(len(codes), lo)
                fresh = len(carry)
            h = codes.copy()
            for n in range(1, max(ORDERS) + 1):
                if n > 1:
                    h = (h[:-1] * np.uint64(0x9E3779B1)) ^ codes[n - 1 :]
                if n in ORDERS and len(h):
                    bucket = ((h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int32)
                    first, last = owner[: len(h)], owner[n - 1 :]
                    use = first == last
                    if fresh:
                        use[: max(0, fresh - n + 1)] = False  # ends in what the last part counted
                    if n == 1:
                        use &= codes != 32
                    yield bucket[use], first[use]
            carry = codes[-(max(ORDERS) - 1) :]


def _is_training(key: Column) -> Column:
    """Rows to learn from: crc32 of the key as text, modulo 4, is not 2."""
    return ~held_out(key)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", rows_per_label: int = FIT_ROWS_PER_LABEL
) -> Model:
    """Learn from rows whose text and label are not null and that ``held_out`` leaves in.

    At most about ``rows_per_label`` rows of each label are drawn, by a hash of the
    key; labels with fewer rows give all.  N-grams are counted in the tasks; the driver
    receives labels x buckets sums, bounded by MOST_LABELS.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")).filter(
        F.col("text").isNotNull() & F.col("label").isNotNull() & _is_training(F.col("key"))
    )
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    labels = tuple(sorted(sizes))
    if not labels:
        return Model((), np.zeros((0, 1 << BUCKETS_LOG2), np.float32), np.zeros(0))
    # One hash border per label: below it lies the share of rows to draw.
    grain = 1 << 30
    border = F.create_map(*[F.lit(x) for name in labels for x in (name, min(grain, rows_per_label * grain // sizes[name] + 1))])
    sample = rows.filter(F.pmod(F.xxhash64("key"), F.lit(grain)) < border[F.col("label")])
    index = {name: i for i, name in enumerate(labels)}
    out = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in source:
            texts, names = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            which = np.array([index[x] for x in names])
            for bucket, owner in _grams(texts):
                of = which[owner]
                for k in np.unique(of):
                    if k not in sums:
                        sums[k] = np.zeros(1 << BUCKETS_LOG2, np.int64)
                    sums[k] += np.bincount(bucket[of == k], minlength=1 << BUCKETS_LOG2)
        for k, total in sums.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells + (int(k) << BUCKETS_LOG2)), pa.array(total[cells])], schema=out)

    cells = sample.select("text", "label").mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(labels), 1 << BUCKETS_LOG2))
    counts.ravel()[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    counts += SMOOTHING
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    prior = np.array([sizes[x] for x in labels], float)
    return Model(labels, log_prob, np.log(prior / prior.sum()))


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of each row with lang_pred and score, from the whole text alone.

    A batch of texts is one sparse row set: the buckets of all its n-grams pick rows of
    the broadcast matrix, which are summed per text.  score is the posterior of the
    predicted label.  Null texts, texts without a letter and a model without labels
    give ``und`` with score 0.  Repeated rows get equal results; other columns than
    ``keep`` are not returned, and ``keep`` may not name lang_pred or score.
    """
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, np.ascontiguousarray(model.log_prob.T), model.log_prior))

    def score(texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, matrix, prior = shared.value
        total, seen = np.zeros((len(texts), len(labels))), np.zeros(len(texts), bool)
        for bucket, owner in _grams(texts):
            if len(bucket) and len(labels):
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                for lo in range(0, len(labels), 16):  # few columns at once: bounded memory
                    total[owner[starts], lo : lo + 16] += np.add.reduceat(matrix[bucket, lo : lo + 16], starts, axis=0, dtype=np.float64)
                seen[owner[starts]] = True
        if not len(labels):
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total += prior
        best = total.argmax(axis=1)
        top = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return (
            [labels[b] if s else UNKNOWN for b, s in zip(best, seen)],
            [float(p) if s else 0.0 for p, s in zip(top, seen)],
        )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            names, scores = score(batch.column("__text").to_pylist())
            kept = [batch.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*[f"k{i}" for i in range(len(keep))], "lang_pred", "score"],
            )

    inner = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("__text"))
    schema = StructType([inner.schema[f"k{i}"] for i in range(len(keep))])
    scored = inner.mapInArrow(tidy(run), schema.add("lang_pred", "string").add("score", "double"))
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
