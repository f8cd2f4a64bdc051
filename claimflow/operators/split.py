"""Exact stratified splits and folds without ranking whole classes.

A ``row_number`` per class would sort a whole class in one task.  Rows are
ordered by a hash of their whole content instead, and only the few hash values
at which one part ends and the next begins are looked up: counts per (class,
hash prefix), then again inside the one prefix each border falls in, with a
longer prefix each time, until a single hash is left.  Rows are then assigned by
comparing their hash with these constants, a narrow projection that shuffles
nothing.

The order depends on content only, so recomputed tasks assign alike.  Rows tied
at a border are exact copies of each other; how many of them go to each side is
settled by their count.  A frame that carries the id of its rows has no copies.

The input is read several times and has to give the same rows each time: pass a
stored table, not a long chain of derivations.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

DIGITS = 4  # hex digits a step looks further: 65,536 counts per class and border
COPY_CHUNK = 100_000

Ranks = Callable[[dict[int, int]], dict[int, list[int]]]


class Border(NamedTuple):
    label: int
    at_rank: int  # rows of the class before the border
    row_hash: str  # hash of the first row after it
    copies_before: int  # copies of that row that still lie before it


class Search(NamedTuple):
    label: int
    at_rank: int
    prefix: str  # of the hash looked for
    before: int  # rows of the class with a smaller prefix


def row_hash(df: DataFrame, seed: int) -> Column:
    """MD5 of the seed and all columns.

    Each cell is preceded by its length, and nulls are a mark without one, so no
    two rows give the same text.
    """
    cells = [F.col(c).cast("string") for c in df.columns]
    sized = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in cells]
    return F.md5(F.concat(F.lit(f"{seed};"), *sized))


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class; the label has to be 0 or 1, so two numbers come back."""
    return _two_classes(df.select(F.col(label).alias("_y"), F.lit(1).alias("_n")), label)


def _two_classes(counts: DataFrame, label: str) -> dict[int, int]:
    n = F.col("_n")
    row = counts.agg(
        *[F.coalesce(F.sum(F.when(F.col("_y") == c, n)), F.lit(0)).alias(f"n{c}") for c in (0, 1)],
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
    ).first()
    if row.n0 + row.n1 != row.n:
        raise ValueError(f"{label} has to be 0 or 1 in every row")
    return {0: row.n0, 1: row.n1}


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _histogram(keyed: DataFrame, length: int) -> DataFrame:
    """Rows per class and hash prefix, and whether one hash is all a prefix holds."""
    return keyed.groupBy("_y", F.substring("_h", 1, length).alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_h").alias("_low"), F.max("_h").alias("_high")
    )


def find_borders(df: DataFrame, label: str, ranks: Ranks, seed: int) -> tuple[list[Border], dict[int, int]]:
    """The hash at each border, and the rows per class; (classes x borders) rows come back per step."""
    y, n = F.col("_y"), F.col("_n")
    keyed = df.select(F.col(label).cast("int").alias("_y"), row_hash(df, seed).alias("_h"))
    first = materialize(_histogram(keyed, DIGITS), "hash-histogram")
    counts = _two_classes(first, label)
    found: list[Border] = []
    open_ = [Search(c, r, "", 0) for c, rs in ranks(counts).items() for r in rs if r < counts[c]]
    length = DIGITS
    while open_:
        parents = sorted({(s.label, s.prefix) for s in open_})
        inside = _any([(y == c) & F.startswith("_prefix", F.lit(p)) for c, p in parents])
        if length == DIGITS:
            table = first
        else:
            # One comparison of the hash: a condition per border would reckon it anew for each.
            known = F.concat(y.cast("string"), F.lit(":"), F.substring("_h", 1, length - DIGITS))
            table = _histogram(keyed.filter(known.isin([f"{c}:{p}" for c, p in parents])), length)
        # One window per class and parent prefix: 65,536 rows at most.
        group = Window.partitionBy("_y", F.substring("_prefix", 1, length - DIGITS)).orderBy("_prefix")
        earlier = F.coalesce(F.sum("_n").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        numbered = table.filter(inside).withColumn("_first", earlier)
        at = F.col("_first")
        hit = _any(
            [
                (y == s.label) & F.startswith("_prefix", F.lit(s.prefix)) & (at <= s.at_rank - s.before) & (at + n > s.at_rank - s.before)
                for s in open_
            ]
        )
        buckets = numbered.filter(hit).collect()
        deeper = []
        for s in open_:
            wanted = s.at_rank - s.before
            [b] = [
                b for b in buckets
                if b._y == s.label and b._prefix.startswith(s.prefix) and b._first <= wanted < b._first + b._n
            ]
            if b._low == b._high:
                found.append(Border(s.label, s.at_rank, b._low, wanted - b._first))
            else:
                deeper.append(Search(s.label, s.at_rank, b._prefix, s.before + b._first))
        open_, length = deeper, length + DIGITS
    return sorted(found), counts


def assign_parts(df: DataFrame, label: str, ranks: Ranks, seed: int, part: str) -> DataFrame:
    """Number each row by how many borders of its class lie at or before it.

    ``ranks`` gives, from the rows per class, the ascending row counts at which a
    new part of each class begins.
    """
    borders, _ = find_borders(df, label, ranks, seed)
    keyed = df.withColumn("_h", row_hash(df, seed))
    number, tied = F.lit(0), F.lit(False)
    for b in borders:
        mine = F.col(label) == b.label
        past = F.col("_h") > b.row_hash if b.copies_before else F.col("_h") >= b.row_hash
        number = number + F.when(mine & past, 1).otherwise(0)
        if b.copies_before:
            tied = tied | (mine & (F.col("_h") == b.row_hash))
    numbered = keyed.withColumn(part, number)
    split_ties = [b for b in borders if b.copies_before]
    if not split_ties:
        return numbered.drop("_h")

    copies = numbered.filter(tied).groupBy(*numbered.columns).agg(F.count(F.lit(1)).alias("_n"))
    spread = _repeat(copies, "_n", "_copy")
    for b in split_ties:
        here = (F.col(label) == b.label) & (F.col("_h") == b.row_hash) & (F.col("_copy") >= b.copies_before)
        spread = spread.withColumn(part, F.col(part) + F.when(here, 1).otherwise(0))
    whole = numbered.filter(~tied).unionByName(spread.drop("_n", "_copy"))
    return whole.drop("_h")


def _repeat(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row ``times`` times with a running index, in chunks over many tasks."""
    last_chunk = ((F.col(times) - 1) / COPY_CHUNK).cast("long")
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    start = F.col("_chunk") * COPY_CHUNK
    end = F.least(start + COPY_CHUNK, F.col(times)) - 1
    return (
        chunks.repartition("_chunk").withColumn(index, F.explode(F.sequence(start, end))).drop("_chunk")
    )


def part_sizes(counts: dict[int, int], fraction: float) -> dict[int, int]:
    """Test rows per class: ceil(fraction * n) shared out by largest remainder."""
    return shares(counts, math.ceil(fraction * sum(counts.values())))


def shares(counts: dict[int, int], drawn: int) -> dict[int, int]:
    """``drawn`` rows shared out over the classes by largest remainder."""
    n = sum(counts.values())
    if n == 0:
        return dict.fromkeys(counts, 0)
    whole = {c: size * drawn // n for c, size in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * drawn % n), c))
    for c in by_remainder[: drawn - sum(whole.values())]:
        whole[c] += 1
    return whole


def draw(df: DataFrame, label: str, n: int, seed: int = 42) -> tuple[DataFrame, dict[int, int]]:
    """Exactly n rows (all, if fewer), each class by its share and at least one of it; the rows per class.

    The first of each class in hash order, ids included: rows with equal features are
    drawn one by one.
    """
    sizes: dict[int, int] = {}

    def ranks(counts: dict[int, int]) -> dict[int, list[int]]:
        drawn = shares(counts, min(n, sum(counts.values())))
        for c in counts:  # a rare class is not lost
            if not drawn[c] and counts[c] and max(drawn.values()) > 1:
                drawn[max(drawn, key=drawn.get)] -= 1
                drawn[c] = 1
        sizes.update(drawn)
        return {c: [size] for c, size in drawn.items()}

    numbered = assign_parts(df, label, ranks, seed, "_drawn")
    return numbered.filter("_drawn = 0").drop("_drawn"), sizes


def _fold_starts(size: int, k: int) -> list[int]:
    return [size * j // k for j in range(1, k)]


def stratified_split(
    df: DataFrame, label: str, fraction: float = 0.2, seed: int = 42, part: str = "parte"
) -> DataFrame:
    """Add ``part``: ``test`` for the fraction of each class first in hash order, else ``train``."""
    numbered = assign_parts(df, label, lambda counts: {c: [size] for c, size in part_sizes(counts, fraction).items()}, seed, part)
    return numbered.withColumn(part, F.when(F.col(part) == 0, "test").otherwise("train"))


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42, fold: str = "fold") -> DataFrame:
    """Add ``fold``: k parts of each class, equal within one row."""
    return assign_parts(df, label, lambda counts: {c: _fold_starts(size, k) for c, size in counts.items()}, seed, fold)


def split_with_folds(
    df: DataFrame, label: str, fraction: float = 0.2, k: int = 5, seed: int = 42, part: str = "parte"
) -> DataFrame:
    """Add ``part``: 0 for the test rows of ``stratified_split``, else 1 to k, the folds of the rest.

    Test part and folds follow one another in hash order, so all borders are looked
    up together and the rows are written once.
    """

    def ranks(counts: dict[int, int]) -> dict[int, list[int]]:
        tested = part_sizes(counts, fraction)
        return {c: [tested[c], *[tested[c] + at for at in _fold_starts(size - tested[c], k)]] for c, size in counts.items()}

    return assign_parts(df, label, ranks, seed, part)


def balanced_weights(df: DataFrame, label: str, weight: str = "peso", counts: dict[int, int] | None = None) -> DataFrame:
    """Add a weight n / (classes * rows of the class)."""
    counts = counts or class_counts(df, label)
    n = sum(counts.values())
    classes = sum(size > 0 for size in counts.values())
    value = F.lit(None).cast("double")
    for c, size in counts.items():
        if size:
            value = F.when(F.col(label) == c, n / (classes * size)).otherwise(value)
    return df.withColumn(weight, value)
