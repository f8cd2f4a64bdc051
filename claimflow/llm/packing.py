"""Best-fit packing of documents into sequences, in bulk-synchronous rounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import materialize, temporaries
from .common import groups_of, tidy
from .tokens import tokenizer

CAPACITY = 4096
END = 1  # the id that ends every document


def pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """(item, key, piece, start, length, ids_crc32) per piece of at most ``capacity`` ids.

    A document is the ids of its text (null: none) and the end id; only longer ones
    are cut.  ``item`` numbers the pieces.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(tokenizer_path)
        item = TaskContext.get().partitionId() << 40
        for batch in source:
            texts, ids = batch.column("t").to_pylist(), batch.column("id")
            for lo, hi in groups_of(texts):
                end = np.array([END], words.kind).tobytes()
                codes = words.encode(texts[lo:hi])
                joined = b"".join([part for code in codes for part in (code, end)])
                data = np.frombuffer(joined, words.kind).astype("<u4")  # as the checksum takes them
                size = np.array([len(code) for code in codes]) // words.kind.itemsize + 1
                many = -(-size // capacity)
                row = np.repeat(np.arange(hi - lo), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                at = 4 * ((np.cumsum(size) - size)[row] + start)
                view = memoryview(data).cast("B")
                crc = [zlib.crc32(view[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                columns = [ids.take(pa.array(row + lo)), item + np.arange(len(row)), piece.astype(np.int32), start, length]
                item += len(row)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(crc, pa.int64())], names=["id", "item", "piece", "start", "length", "ids_crc32"]
                )
        words.rest()

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
    schema = StructType([rows.schema["id"]]).add("item", "long").add("piece", "integer")
    return rows.mapInArrow(tidy(run), schema.add("start", "long").add("length", "long").add("ids_crc32", "long"))


def _sweep(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match the items and gaps of one range of sizes, largest first.

    Each item takes the smallest gap seen and still free: its successor, unless items
    of higher rank have it.  Items without one and gaps left over are numbered, for
    the match across ranges.
    """
    part = TaskContext.get().partitionId()
    free_bin: list[int] = []
    free_slot: list[int] = []
    unmatched = 0
    schema = pa.schema(
        [("part", pa.int32()), ("item", pa.int64()), ("size", pa.int64()), ("bin", pa.int64()), ("slot", pa.int64()), ("rank", pa.int64())]
    )
    for batch in source:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("item", "size", "bin", "slot"))
        for item, size, of, slot in zip(*columns):
            if item is None:
                free_bin.append(of)
                free_slot.append(slot)
            elif free_bin:
                rows.append((part, item, size, free_bin.pop(), free_slot.pop(), None))
            else:
                rows.append((part, item, size, None, None, unmatched))
                unmatched += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    n = len(free_bin)
    for lo in range(0, n, 50_000):
        hi = min(n, lo + 50_000)
        none = pa.nulls(hi - lo, pa.int64())
        # rank 0 is the smallest: the top of the stack
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(hi - lo, part, np.int32)),
                none,
                none,
                pa.array(free_bin[lo:hi], pa.int64()),
                pa.array(free_slot[lo:hi], pa.int64()),
                pa.array(np.arange(n - 1 - lo, n - 1 - hi, -1)),
            ],
            schema=schema,
        )


def _across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(part, rank, n, gap part, gap rank): runs of unmatched items and the earlier gaps they take.

    ``counts`` has (part, unmatched items, gaps left) in order of the ranges; the
    driver holds one number pair per task, never rows.
    """
    out, stack = [], []
    for part, items, gaps in counts:
        rank = 0
        while rank < items and stack:
            q, used, left = stack.pop()
            n = min(items - rank, left)
            out.append((part, rank, n, q, used))
            rank += n
            if left > n:
                stack.append((q, used + n, left - n))
        if gaps:
            stack.append((part, 0, gaps))
    return out


def assign(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, size, bin, round, slot) for rows (item, size), sizes 1 to ``capacity``.

    Each round range-sorts what is left with the gaps, sweeps every range for
    successors, settles the rest across ranges by rank, and updates the gaps.  Gaps
    far larger than all items left are offered in several slots; items that fit
    nowhere open new sequences, as many as their sizes need at least.
    """
    spark = items.sparkSession
    left = items
    bins = spark.createDataFrame([], "bin long, gap long")
    placed, opened, number = [], 0, 0
    while True:
        rest = left.agg(F.count("*").alias("n"), F.max("size").alias("most"), F.min("size").alias("least")).first()
        if not rest["n"]:
            break
        bins = bins.filter(F.col("gap") >= rest["least"])
        room = bins.agg(F.count("*").alias("n"), F.coalesce(F.max("gap"), F.lit(0)).alias("most")).first()
        new = 0
        if rest["most"] > room["most"]:
            need = left.filter(F.col("size") > room["most"]).agg(F.sum("size")).first()[0]
            new = -(-need // capacity)
            bins = bins.union(spark.range(opened, opened + new).select(F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap")))
            opened += new
        # As many slots as the gap holds of the largest item left, and no more than there is use for.
        slots = F.least(F.col("gap") / rest["most"], F.lit(2 * rest["n"] / (room["n"] + new) + 1))
        many = F.greatest(F.floor(slots), F.lit(1))
        gaps = bins.select("bin", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("slot"), F.floor(F.col("gap") / many).alias("size"))
        none = F.lit(None).cast("long")
        rows = left.select("item", "size", none.alias("bin"), none.alias("slot")).union(gaps.select(none, "size", "bin", "slot"))
        # Gaps before items of their size; equal sizes may spread over ranges.
        order = [F.col("size").desc(), F.col("item").asc_nulls_first(), F.col("bin"), F.col("slot")]
        swept = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        swept = materialize(
            swept.mapInArrow(_sweep, "part int, item long, size long, bin long, slot long, rank long"), "packing-sweep"
        )
        counts = (
            swept.groupBy("part")
            .agg(F.count_if(F.expr("item IS NOT NULL AND bin IS NULL")).alias("items"), F.count_if(F.expr("item IS NULL")).alias("gaps"))
            .orderBy("part")
            .collect()
        )
        runs = spark.createDataFrame(_across([tuple(r) for r in counts]), "to_part int, to_rank long, n long, q int, used long")
        taken = (
            swept.filter("item IS NULL")
            .join(F.broadcast(runs), F.expr("part = q AND rank >= used AND rank < used + n"))
            .select("to_part", (F.col("to_rank") + F.col("rank") - F.col("used")).alias("to_rank"), F.col("bin").alias("b"), F.col("slot").alias("s"))
        )
        here = swept.filter("item IS NOT NULL")
        met = here.join(taken, F.expr("part = to_part AND rank = to_rank"), "left").select(
            "item", "size", F.coalesce("bin", "b").alias("bin"), F.coalesce("slot", "s").alias("slot")
        )
        met = materialize(met, "packing-round")
        done = met.filter("bin IS NOT NULL")
        placed.append(done.select("item", "bin", F.lit(number).alias("round"), "slot"))
        used = done.groupBy("bin").agg(F.sum("size").alias("used"))
        bins = bins.join(used, "bin", "left").select("bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"))
        bins = materialize(bins.filter("gap > 0"), "packing-gaps")
        left = met.filter("bin IS NULL").select("item", "size")
        number += 1
    out = spark.createDataFrame([], "item long, bin long, round int, slot long")
    for part in placed:
        out = out.union(part)
    return out


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Every piece of every row has a place; the pieces of a sequence follow one another
    without gaps from offset 0.  Null and empty texts are the end id alone, very long
    ones several pieces; null keys and repeated rows are documents of their own.  Extra
    columns are not returned.  An empty table gives an empty result.
    """
    table = materialize(pieces(docs, tokenizer_path, text, key, capacity), "packing-pieces")
    with temporaries(docs.sparkSession):
        spots = materialize(assign(table.select("item", F.col("length").alias("size")), capacity), "packing-spots", keep=True)
    return table.join(spots, "item").select(
        F.col("id").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("bin").alias("sequence_id"),
        F.expr(
            "sum(length) OVER (PARTITION BY bin ORDER BY round, slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length"
        ).alias("offset"),
    )
