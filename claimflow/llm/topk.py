"""Exact top-k search by inner product: tiles of queries and shards, merged in a tree.

Vectors are packed, some thousands to a row, by narrow passes.  Every wave of queries
(a bounded number of bytes) meets every group of shards in one task: it takes the wave
first and then streams the shards, one matrix product and one partial selection per
tile.  The lists of the groups are merged by a tree of fixed fan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporaries

SCALE = 1024  # a component x counts as floor(SCALE * x)
SHARD_ROWS = 16_384  # candidates of a packed shard, fewer where vectors are wide
BLOCK_ROWS = 256  # queries of a tile
PACKED_BYTES = 4 << 20  # of a packed row
WAVE_BYTES = 32 << 20  # queries a task holds
GROUP_SHARDS = 16  # shards a task streams past them, at most
FAN = 16  # lists merged at once
_EXACT = float(1 << 53)  # whole numbers below it are exact as doubles
_WIDE = 1 << 20  # vectors with components beyond it are packed apart: their products may need longer numbers
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_PACKED = "pack long, dim int, n int, wide boolean, ids binary, free binary, vectors binary"
_LISTS = "block long, part long, n int, ids binary, free binary, own binary, top binary, k int"


def _numbers(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.floor(np.float64(scale) * values.astype(np.float64))


def _usable(vectors: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vectors take part, and their whole numbers."""
    at, out = [], []
    vectors = vectors.cast(pa.list_(pa.float64()))
    flat = vectors.values
    holes = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        bad = holes | ~np.isfinite(values)
    whole = _numbers(values, scale)
    bad |= ~np.isfinite(whole)  # beyond the largest double once scaled
    ends = vectors.offsets.to_numpy()
    before = np.r_[0, np.cumsum(bad)]
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(there & (before[ends[1:]] == before[ends[:-1]])).tolist():
        at.append(i)
        out.append(whole[ends[i] : ends[i + 1]])
    return np.array(at, np.int64), out


def _pack(rows: DataFrame, id: str, vector: str, scale: int, most_rows: int) -> DataFrame:
    """Packed vectors: rows of at most ``most_rows`` vectors of one length, narrow."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}
        number, size = TaskContext.get().partitionId() << 33, 0

        def close(kind: tuple[int, bool]) -> pa.RecordBatch:
            nonlocal number, size
            (dim, wide), rows = kind, held.pop(kind)
            size -= len(rows) * (dim + 16)
            m = np.array([v for _, v in rows]).reshape(len(rows), dim)
            free = np.array([i is None for i, _ in rows])
            ids = np.array([i or 0 for i, _ in rows], np.int64)
            number += 1
            columns = [number, dim, len(rows), wide, ids.tobytes(), np.packbits(free).tobytes(), m.astype("<f8" if wide else "<i4").tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            names = ["pack", "dim", "n", "wide", "ids", "free", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], names=names)

        for batch in source:
            at, vectors = _usable(batch.column("v"), scale)
            ids = batch.column("id").to_pylist()
            for i, v in zip(at.tolist(), vectors):
                dim = len(v)
                kind = dim, bool(dim) and float(np.abs(v).max()) >= _WIDE
                held.setdefault(kind, []).append((ids[i], v))
                size += dim + 16
                if len(held[kind]) >= min(most_rows, max(1, PACKED_BYTES // (4 * max(1, dim)))):
                    yield close(kind)
                elif size > 2 * PACKED_BYTES:  # vectors of many lengths
                    yield close(max(held, key=lambda d: len(held[d]) * (d[0] + 16)))
        for kind in list(held):
            yield close(kind)

    return rows.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(run, _PACKED)


class _Block:
    """Vectors of one packed row, in the order of their ids, null ids last."""

    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        ids = np.frombuffer(row["ids"], "<i8")
        free = np.unpackbits(np.frombuffer(row["free"], np.uint8), count=n).astype(bool)
        m = np.frombuffer(row["vectors"], "<f8" if row["wide"] else "<i4").reshape(n, dim)
        order = np.lexsort((ids, free))
        self.ids, self.free, self.dim = ids[order], free[order], dim
        self.m = m[order].astype(np.float64)
        with np.errstate(over="ignore"):
            self.norm = float(np.sqrt((self.m**2).sum(axis=1).max())) if m.size else 0.0


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as longs; those beyond a long stand at its ends."""
    if exact:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = [[sum(p * q for p, q in zip(left, right)) for right in whole] for left in ([int(x) for x in row] for row in a)]
    return np.array([[min(_MOST, max(_LEAST, x)) for x in row] for row in out], np.int64).reshape(len(a), len(b))


_ENTRY = np.dtype([("score", "<i8"), ("id", "<i8"), ("free", "?"), ("there", "?")])


def _best(scores: np.ndarray, ids: np.ndarray, free: np.ndarray, k: int, narrow: bool) -> np.ndarray:
    """Per row the k highest scores, ties to the candidate that stands first; ids ascend, null ids last."""
    n = scores.shape[1]
    if narrow and n <= 1 << 16:  # score and place in one long: a partial selection is exact, ties too
        key = (scores << 16) | (0xFFFF - np.arange(n))
        if n > k:
            key = np.partition(key, n - k, axis=1)[:, n - k :]
        key = -np.sort(-key, axis=1)
        place, score = 0xFFFF - (key & 0xFFFF), key >> 16
    else:
        place = np.argsort(-scores.astype(object) if n and scores.min() == _LEAST else -scores, axis=1, kind="stable")[:, :k]
        score = np.take_along_axis(scores, place, axis=1)
    out = np.zeros((len(scores), k), _ENTRY)
    found = out[:, : place.shape[1]]
    found["score"], found["id"], found["free"], found["there"] = score, ids[place], free[place], True
    return out


def _merged(lists: np.ndarray, k: int) -> np.ndarray:
    """The k best entries of each row of ``lists``."""
    order = np.lexsort((lists["id"], lists["free"], ~lists["score"], ~lists["there"]), axis=1)[:, :k]  # ~x falls as x rises
    return np.take_along_axis(lists, order, axis=1)


def _list_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    names = ["block", "part", "n", "ids", "free", "own", "top", "k"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _tile(source: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows by (wave, part), queries first: one list row per query block and part."""
    now, blocks, lists = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        for (number, b, own), top in zip(blocks, lists):
            if top is not None:
                yield _list_batch([(number, now[1], len(b.ids), b.ids.tobytes(), np.packbits(b.free).tobytes(), own.tobytes(), top.tobytes(), k)])
        blocks.clear()
        lists.clear()

    for batch in source:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if (row["wave"], row["part"]) != now:
                yield from flush()
                now = row["wave"], row["part"]
            b = _Block(row)
            if row["query"]:
                own = np.concatenate([_products(b.m[j : j + 1], b.m[j : j + 1], b.norm * b.norm * 1.01 + 1 < _EXACT)[0] for j in range(len(b.ids))])
                blocks.append((row["pack"], b, own))
                lists.append(None)
                continue
            for j, (_, q, _) in enumerate(blocks):
                if q.dim != b.dim:
                    continue
                bound = q.norm * b.norm * 1.01 + 1
                scores = _products(q.m, b.m, bound < _EXACT)
                top = _best(scores, b.ids, b.free, k, bound < 1 << 46)
                lists[j] = top if lists[j] is None else _merged(np.concatenate([lists[j], top], axis=1), k)
    yield from flush()


def _merge_group(rows: pa.Table) -> pa.Table:
    first = rows.slice(0, 1).to_pylist()[0]
    n, k = first["n"], first["k"]
    lists = np.concatenate([np.frombuffer(t, _ENTRY).reshape(n, k) for t in rows["top"].to_pylist()], axis=1)
    return rows.slice(0, 1).set_column(rows.schema.get_field_index("top"), "top", pa.array([_merged(lists, k).tobytes()], pa.binary()))


def _unpack(source: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Lists as rows, each without the entry that is the query's own row."""
    for batch in source:
        for row in batch.to_pylist():
            n = row["n"]
            ids, own = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["own"], "<i8")
            free = np.unpackbits(np.frombuffer(row["free"], np.uint8), count=n).astype(bool)
            top = np.frombuffer(row["top"], _ENTRY).reshape(n, k + 1)
            itself = top["there"] & (top["free"] == free[:, None]) & (top["free"] | (top["id"] == ids[:, None])) & (top["score"] == own[:, None])
            itself &= np.cumsum(itself, axis=1) == 1  # one row only: others with this id are candidates
            left = top["there"] & ~itself
            rank = np.cumsum(left, axis=1)
            left &= rank <= k
            q, e = np.nonzero(left)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[q], pa.int64(), mask=free[q]),
                    pa.array(rank[q, e].astype(np.int32)),
                    pa.array(top["id"][q, e], pa.int64(), mask=top["free"][q, e]),
                    pa.array(top["score"][q, e]),
                ],
                names=["query_id", "rank", "vec_id", "score"],
            )


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k highest inner products with other rows.

    A component x counts as floor(scale * x); products are exact whole numbers, and
    those beyond a long stand at its ends.  Ties go to the smaller id, null ids last.
    Every row but the query's own is a candidate, a repeated row too; a repeated query
    row gets a list for each time.  Where there are fewer candidates, all are returned.

    Vectors that are null, hold a null or non-finite component (or one that is not
    finite once scaled) take no part; vectors meet those of their own length only, and
    empty ones score 0.  A query without candidates and an empty table give no rows.
    Extra columns do not matter.  A task holds about WAVE_BYTES of queries
    with their lists and one packed shard, however many vectors there are.
    """
    spark = rows.sparkSession
    with temporaries(spark):
        shards = materialize(_pack(rows, id, vector, scale, SHARD_ROWS), "shards")
        queries = materialize(_pack(rows.filter(is_query), id, vector, scale, BLOCK_ROWS), "query-blocks")
        size = F.col("n").cast("long") * (F.col("dim") * F.lit(8) + F.lit(26 * (k + 2)))
        bytes_of_queries = queries.agg(F.sum(size)).first()[0] or 0
        n_shards = shards.count()
        if not bytes_of_queries or not n_shards:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        waves = -(-bytes_of_queries // WAVE_BYTES)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(n_shards, max(-(-tasks // waves), -(-n_shards // GROUP_SHARDS))))
        wave_of, part_of = F.pmod(F.xxhash64("pack"), F.lit(waves)), F.pmod(F.xxhash64("pack"), F.lit(parts))
        meet = queries.select(
            wave_of.alias("wave"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(True).alias("query"), "*"
        ).union(
            shards.select(
                F.explode(F.sequence(F.lit(0).cast("long"), F.lit(waves - 1).cast("long"))).alias("wave"), part_of.alias("part"), F.lit(False).alias("query"), "*"
            )
        )
        task = (F.col("wave") * parts + F.col("part")).cast("int")
        dealt = meet.repartitionById(waves * parts, task).sortWithinPartitions("wave", "part", F.desc("query"), "pack")
        # k + 1, since the query's own row is a candidate until the end.
        lists = materialize(dealt.mapInArrow(lambda source: _tile(source, k + 1), _LISTS), "top-lists", keep=True)
    while parts > 1:
        parts = -(-parts // FAN)
        grouped = lists.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("block", "part")
        lists = grouped.applyInArrow(_merge_group, _LISTS)
    return lists.mapInArrow(lambda source: _unpack(source, k), "query_id long, rank int, vec_id long, score long")
