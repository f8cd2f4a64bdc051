"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: each byte shifts it by one and adds
its number from a table, so it knows the last 32 bytes.  A chunk ends before a word
where the top bits are zero, or, where the last 64 bytes hold no ASCII white space,
before any character where more of them are.  Borders so depend on nearby bytes only, and
text inserted before a passage does not move those inside it, in unspaced scripts either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import materialize, temporaries
from .common import Members

MASK_BITS = 2  # one word start in four ends a chunk
UNSPACED_BITS = 4  # one character in sixteen, where no white space is near
NEAR = 64  # bytes without white space that make text unspaced; single long words, such as keys, stay whole
LEAST, MOST = 24, 1024  # bytes of a chunk; the last of a text may be shorter
LEAST_RUN = 120  # bytes: shorter repeats, such as common phrases, stay
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_BLOCK = 1 << 20


def borders(data: bytes) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    out, last, n = [], 0, len(data)
    for at in range(0, n, _BLOCK):
        lo = max(0, at - NEAR + 1)  # the hash of a byte needs the 31 before it, unspaced text more
        a = np.frombuffer(data, np.uint8, min(n, at + _BLOCK) - lo, lo)
        h = _GEAR[a]
        for k in (1, 2, 4, 8, 16):
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        word = np.zeros(len(a), bool)  # a white space byte before another one
        word[:-1] = _SPACE[a[:-1]] & ~_SPACE[a[1:]]
        if lo + len(a) < n:
            word[-1] = _SPACE[a[-1]] and not _SPACE[data[lo + len(a)]]
        ends = word & (h >> np.uint32(32 - MASK_BITS) == 0)
        bare = np.zeros(len(a), bool)  # the last NEAR bytes are no white space and a character begins behind them
        if len(a) >= NEAR:
            spaces = np.cumsum(np.r_[False, _SPACE[a]])
            bare[NEAR - 1 :] = spaces[NEAR:] == spaces[:-NEAR]
        bare[:-1] &= a[1:] & 0xC0 != 0x80
        bare[-1] &= lo + len(a) < n and data[lo + len(a)] & 0xC0 != 0x80
        ends |= bare & (h >> np.uint32(32 - UNSPACED_BITS) == 0)
        ends[: at - lo] = False
        for end in (np.flatnonzero(ends) + lo + 1).tolist():
            while end - last > MOST:
                last = _whole(data, last + MOST)
                out.append(last)
            if end - last >= LEAST:
                out.append(end)
                last = end
    while n - last > MOST:
        last = _whole(data, last + MOST)
        out.append(last)
    if n > last:
        out.append(n)
    return out


def _whole(data: bytes, at: int) -> int:
    """``at``, or the place before it where a character begins."""
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _chunks(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, th, lo, hi, digest, digest2) of all chunks; the digest has 128 bits."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        names = ["id", "th", "lo", "hi", "digest", "digest2"]
        for batch in source:
            rows, lo, hi, sums = [], [], [], []
            for i, t in enumerate(batch.column("t")):
                data = (t.as_py() or "").encode()
                ends = borders(data)
                starts = [0, *ends[:-1]]
                rows += [i] * len(ends)
                lo += starts if ends else []
                hi += ends
                sums += [digest(data[a:b]) for a, b in zip(starts, ends)]
                if len(rows) > 100_000:
                    yield _table(batch, rows, lo, hi, sums, names)
                    rows, lo, hi, sums = [], [], [], []
            if rows:
                yield _table(batch, rows, lo, hi, sums, names)

    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    schema = StructType([rows.schema["id"], rows.schema["th"]]).add("lo", "integer").add("hi", "integer")
    return rows.mapInArrow(run, schema.add("digest", "long").add("digest2", "long"))


def _table(batch, rows, lo, hi, sums, names) -> pa.RecordBatch:
    at, sums = pa.array(rows, pa.int32()), np.frombuffer(b"".join(sums), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(at),
            batch.column("th").take(at),
            pa.array(lo, pa.int32()),
            pa.array(hi, pa.int32()),
            pa.array(sums[:, 0].copy()),
            pa.array(sums[:, 1].copy()),
        ],
        names=names,
    )


def repeated_chunks(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, th, spans): per row key and text hash, the sorted byte spans of chunks seen earlier.

    Earlier is by key (nulls last), text hash and place.  Two chunks are equal if their
    lengths and the 128 bits of their digests are.
    """
    chunks = materialize(_chunks(docs, text, key), "chunks")
    many = materialize(chunks.groupBy("digest").count().filter("count > 1").select("digest"), "chunks-many")
    hits = Members(many, "digest").mark(chunks, "digest").filter("hit").drop("hit")
    hits = materialize(hits.withColumn("size", F.col("hi") - F.col("lo")), "chunks-repeated")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "lo")
    first = materialize(
        hits.groupBy("digest", "digest2", "size").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "chunks-first"
    )
    # Two stored tables: a chunk that a third of the texts share is split at run time.
    again = hits.join(first, ["digest", "digest2", "size"]).filter(at != F.col("first"))
    return again.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))


def runs_of(spans: list, least: int) -> list[tuple[int, int]]:
    """Adjoining spans as one; those of at least ``least`` bytes."""
    out: list[list[int]] = []
    for s in spans or []:
        if out and s["lo"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["hi"])
        else:
            out.append([s["lo"], s["hi"]])
    return [(a, b) for a, b in out if b - a >= least]


def with_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", least_run: int = LEAST_RUN) -> DataFrame:
    """(doc, spans, rest) per row of ``docs``: byte spans of repeated text and the text without them."""
    with temporaries(docs.sparkSession):
        gone = materialize(repeated_chunks(docs, text, key), "chunks-gone", keep=True)
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("r_id"), F.xxhash64(text).alias("r_th"))
    rows = rows.join(gone, F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_th") == F.col("th")), "left")
    rows = rows.select("doc", F.col("doc")[text].alias("rest"), "spans")

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts, spans = [], []
            for t, s in zip(batch.column("rest"), batch.column("spans")):
                value, runs = t.as_py(), runs_of(s.as_py(), least_run)
                if runs:
                    data, done, parts = value.encode(), 0, []
                    for lo, hi in runs:
                        parts.append(data[done:lo])
                        done = hi
                    value = b"".join([*parts, data[done:]]).decode()
                texts.append(value)
                spans.append([{"lo": a, "hi": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                names=["doc", "rest", "spans"],
            )

    return rows.mapInArrow(cut, rows.schema)


def substring_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", least_run: int = LEAST_RUN) -> DataFrame:
    """``docs`` with the columns it has, without passages that stand earlier in the corpus.

    The first occurrence of a passage stays; so do repeats of fewer than ``least_run``
    bytes.  Nulls stay null; null keys come after all others.  Rows equal in key and
    text count as one and keep the same passages.  Long texts are hashed in blocks.
    Extra columns travel inside a struct.  An empty table gives an empty result.
    """
    done = with_repeats(docs, text, key, least_run)
    return done.select(*[F.col("rest").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
