"""SimHash near-dedup: fingerprints, vantage-point shards, exact pairs, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporaries
from .common import tidy
from .components import components
from .tokens import cuts

SHINGLE = 3  # words
RADIUS = 2  # differing bits that still link
LEAF_ROWS = 1_024  # fingerprints a leaf of the tree should hold
MAX_DEPTH = 20  # a million leaves for a billion fingerprints: the broadcast tree stays under 12 MB
SAMPLE_PER_LEAF = 16  # fingerprints drawn to place the vantage points, SAMPLE_MOST in all
SAMPLE_MOST = 1 << 22  # 32 MB
BLOCK_ROWS = 16_384  # a leaf of more rows is dealt to several groups, of two such blocks each
_SEED = 42
_CUT = 1 << 20


def _hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, in blocks."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    emitted = False
    for part in cuts(text.encode().lower(), _CUT):  # lowers A-Z only, as bytes
        words = carry + part.split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size + 1) - 1
            start = (end - size)[: len(words) - shingle + 1].tolist()
            yield np.array([digest(joined[s:e], _SEED) for s, e in zip(start, end[shingle - 1 :].tolist())], np.uint64)
            emitted = True
        carry = words[max(0, len(words) - shingle + 1) :] if shingle > 1 else []
    if not emitted and carry:
        yield np.array([digest(b" ".join(carry), _SEED)], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingle hashes; 0 for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    for h in _hashes(text or "", shingle):
        for lo in range(0, len(h), 1 << 16):
            block = h[lo : lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > n).tolist())) if n else 0


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(id, th, fp) per row of ``docs``: a hash of the text, and the 64 bits as a signed long."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["id", "th", "fp"],
            )

    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    return rows.mapInArrow(tidy(run), rows.select("id", "th").schema.add("fp", "long"))


class Tree:
    """A vantage-point tree of fixed depth; node k has the children 2k+1 and 2k+2."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.depth, self.radius = depth, radius
        self.point = np.zeros((1 << depth) - 1, np.uint64)
        self.border = np.full((1 << depth) - 1, 64, np.int16)  # 64: all to the left
        inside = {0: np.unique(sample)}
        for node in range(len(self.point)):
            rows = inside.pop(node, np.array([], np.uint64))
            left, right = rows, rows[:0]
            if len(rows) > 1:
                self.point[node], self.border[node] = self._best(rows)
                d = np.bitwise_count(rows ^ self.point[node])
                left, right = rows[d <= self.border[node]], rows[d > self.border[node]]
            inside[2 * node + 1], inside[2 * node + 2] = left, right

    def _best(self, rows: np.ndarray) -> tuple[np.uint64, int]:
        """The point and border that cut near the middle with the fewest rows by the border."""
        best = None
        for point in rows[:: max(1, len(rows) // 24)][:24]:
            share = np.cumsum(np.bincount(np.bitwise_count(rows ^ point), minlength=65)) / len(rows)
            for border in {int(np.searchsorted(share, q)) for q in (0.4, 0.5, 0.6)}:
                near = share[min(64, border + self.radius)] - (share[border - self.radius - 1] if border > self.radius else 0)
                cost = near + abs(share[min(border, 64)] - 0.5)
                if best is None or cost < best[0]:
                    best = cost, point, border
        return best[1], best[2]

    def shards(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, is its home) for the home of each row and every later leaf its ball may reach.

        By the triangle bound, what lies within ``radius`` of a row at distance d from
        the point is left of the border only if d <= border + radius, and right only if
        d > border - radius.  Of two rows in different leaves, the one in the earlier
        leaf visits the other's, so visits to earlier leaves are left out.
        """
        row, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        home = np.ones(len(fps), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(fps[row] ^ self.point[node]).astype(np.int16)
            border = self.border[node]
            at_left = d <= border
            left, right = d <= border + self.radius, d > border - self.radius
            # Once off the home path to the left, all leaves are earlier than the home.
            left &= at_left | ~home
            row, home, node = (
                np.r_[row[left], row[right]],
                np.r_[(home & at_left)[left], (home & ~at_left)[right]],
                np.r_[2 * node[left] + 1, 2 * node[right] + 2],
            )
        return row, node - len(self.point), home


def _forest(meetings: list[tuple[np.ndarray, np.ndarray]], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join, per meeting (rows, targets), each row with the targets within ``radius``.

    A forest, not all pairs.
    """
    nodes = np.unique(np.concatenate([x for meeting in meetings for x in meeting]))
    parent = np.arange(len(nodes))

    def roots(k: np.ndarray) -> np.ndarray:
        r = parent[k]
        while (parent[r] != r).any():
            r = parent[r]
        return r

    for rows, targets in meetings:
        rows, targets = np.unique(rows), np.unique(targets)
        own, at = np.searchsorted(nodes, rows), np.searchsorted(nodes, targets)
        step = max(1, 2_000_000 // max(1, len(targets)))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            near = np.bitwise_count(part[:, None] ^ targets[None, :]) <= radius
            for i in np.flatnonzero(near.sum(axis=1) > np.isin(part, targets, assume_unique=True)):
                r = np.unique(roots(np.r_[own[lo + i], at[near[i]]]))
                parent[r] = r[0]
    r = roots(np.arange(len(nodes)))
    moved = r != np.arange(len(nodes))
    return nodes[moved], nodes[r[moved]]


def links(distinct: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs within ``radius`` bits.

    A bounded sample places the vantage points; every fingerprint goes to its home
    leaf and, as a query, to the later leaves that its ball may overlap, so every pair
    meets in one leaf.  Large leaves are cut into blocks, of which every two meet in a
    group, so no group grows with a leaf.  A group emits a spanning forest of its pairs:
    dense groups give rows, not squares of rows.
    """
    spark = distinct.sparkSession
    depth = max(0, min(MAX_DEPTH, math.ceil(math.log2(max(1, n / LEAF_ROWS)))))
    grain = 1 << 30
    share = min(grain, grain * min(SAMPLE_MOST, SAMPLE_PER_LEAF << depth) // max(1, n) + 1)
    sample = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(grain)) < share).select("fp").toArrow()["fp"].to_numpy()
    tree = spark.sparkContext.broadcast(Tree(sample.view(np.uint64), depth, radius))

    def route(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            row, leaf, home = tree.value.shards(fps)
            for lo in range(0, len(row), 100_000):
                k = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[k].astype(np.int32)), pa.array(fps[row[k]].view(np.int64)), pa.array(home[k])],
                    names=["leaf", "fp", "home"],
                )

    routed = materialize(distinct.select("fp").mapInArrow(route, "leaf int, fp long, home boolean"), "shards")
    # Leaves of very many rows are cut into blocks, and every two blocks meet in a group.
    # MAX_DEPTH bounds the leaves, so their sizes are small enough to broadcast.
    large = routed.groupBy("leaf").count().filter(F.col("count") > BLOCK_ROWS)
    large = materialize(large.select("leaf", F.ceil(F.col("count") / BLOCK_ROWS).alias("many")), "large-leaves")
    dealt = routed.join(F.broadcast(large), "leaf", "left").withColumn("many", F.coalesce("many", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("many"))).select(
        "leaf", "fp", "home", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)).alias("other")
    )
    dealt = dealt.select("leaf", "fp", "home", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def pairs(group: pa.Table) -> pa.Table:
        fps, home = group["fp"].to_numpy().view(np.uint64), group["home"].to_numpy(zero_copy_only=False)
        low = group["own"].to_numpy() == group["low"].to_numpy()
        if group["low"][0] == group["high"][0]:
            meetings = [(fps, fps[home])]
        else:
            meetings = [(fps[low], fps[~low & home]), (fps[~low & ~home], fps[low & home])]
        a, b = _forest(meetings, radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "leaf", "low", "high").groupBy("leaf", "low", "high").applyInArrow(pairs, "a long, b long")


def _grouped(docs: DataFrame, text: str, key: str, shingle: int, radius: int) -> DataFrame:
    """(id, th, fp, root, component_id) per row of ``docs``."""
    with temporaries(docs.sparkSession):
        prints = materialize(fingerprints(docs, text, key, shingle), "fingerprints", keep=True)
        distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")), "fingerprints-distinct")
        found = components(links(distinct, distinct.count(), radius), "a", "b")
        rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        rooted = materialize(rooted, "fingerprints-rooted")
        heads = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = materialize(rooted.join(heads, "root").select("fp", "root", "component_id"), "fingerprints-named", keep=True)
    # Two stored tables: a fingerprint that a third of all rows share is split at run time.
    return prints.join(named, "fp")


def simhash_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(key, fp, component_id) per row of ``docs``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id
    is the smallest key reachable.  Equal fingerprints are one node, so copies are
    never expanded into pairs.

    Nulls: a null or empty text has fingerprint 0, which links like any other; null
    keys are passed over in the minimum (a group of null keys alone has a null id).
    Repeated rows are returned as often as they come; very long texts are hashed in
    blocks; an empty table gives no rows.  Extra columns are not returned.
    """
    return _grouped(docs, text, key, shingle, radius).select(F.col("id").alias(key), "fp", "component_id")


def near_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each group of ``simhash_groups``: that with the smallest key.

    Null keys come after all others; of rows with one key, that with the smallest text
    hash stays, and of rows equal in both a single one.  A null or empty text has
    fingerprint 0 like any other text without words, so one of them stays.  All columns
    are returned as they are; an empty table gives no rows.

    What is decided on are narrow rows.  Whole rows meet the keys of those that go, and
    are moved only if these are too many to broadcast, or where a row that stays is
    there more than once.
    """
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    with temporaries(docs.sparkSession):
        groups = materialize(_grouped(docs, text, key, shingle, radius).select("id", "th", "root"), "near-groups")
        keep = groups.groupBy("root").agg(F.min(order).alias("k"))
        gone = groups.join(keep, "root").filter(order != F.col("k")).select("id", "th").distinct()
        gone = materialize(gone, "near-gone", keep=True)
        again = groups.groupBy("id", "th").count().filter("count > 1").select("id", "th")
        again = materialize(again.join(gone, _same("id", "th", again, gone), "left_anti"), "near-repeats", keep=True)
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("r_id"), F.xxhash64(text).alias("r_th"))
    kept = rows.join(gone, F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_th") == F.col("th")), "left_anti")
    if again.isEmpty():
        return kept.select("doc.*")
    repeated = F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_th") == F.col("th"))
    once = kept.join(again, repeated, "left_semi").dropDuplicates(["r_id", "r_th"])
    return kept.join(again, repeated, "left_anti").union(once).select("doc.*")


def _same(id: str, th: str, left: DataFrame, right: DataFrame) -> Column:
    return left[id].eqNullSafe(right[id]) & (left[th] == right[th])
