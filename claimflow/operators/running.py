"""Running totals over a whole ordered table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def totals_above(df: DataFrame, score: str, sums: list[str]) -> DataFrame:
    """Add ``<name>_above``: each sum over all rows with a higher score, and ``<name>_total``.

    ``df`` has one row per distinct score.  An unpartitioned window would put them
    all in one task.  Instead scores are range-partitioned and stored with the range
    they fell in: a window ranges over the scores of one range, and one over the
    ranges, of which there is one per task.  Ranges hold about equal numbers of
    scores, however close or far apart those are.
    """
    stored = materialize(df.repartitionByRange(F.desc(score)).withColumn("_range", F.spark_partition_id()), "score-ranges")
    earlier = Window.unboundedPreceding, -1

    def above(name: str, window) -> F.Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    per_range = stored.groupBy("_range").agg(*[F.sum(s).alias(s) for s in sums])
    over_ranges = Window.orderBy("_range").rowsBetween(*earlier)  # as many rows as ranges
    offsets = per_range.select(
        "_range",
        *[above(s, over_ranges).alias(f"_r_{s}") for s in sums],
        *[F.sum(s).over(Window.partitionBy()).alias(f"{s}_total") for s in sums],
    )
    over_scores = Window.partitionBy("_range").orderBy(F.desc(score)).rowsBetween(*earlier)
    ranked = stored.withColumns({f"_s_{s}": above(s, over_scores) for s in sums})
    return ranked.join(offsets, "_range").select(
        *df.columns,
        *[(F.col(f"_r_{s}") + F.col(f"_s_{s}")).alias(f"{s}_above") for s in sums],
        *[f"{s}_total" for s in sums],
    )
