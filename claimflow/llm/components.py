"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node of its component.

    Alternating large-star and small-star steps: neighbours are moved to the smallest
    node in sight until every component is a star.  Steps are joins and minima, so a
    hub's links are combined before they move; each step is a stored table.  The
    driver sees two numbers per round.  Rows with a null end and self-links link nothing.
    """
    pair = (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*pair).distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = materialize(
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star"
        )
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
