"""Standardising numbers and coding categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

CONSTANT_CODES = 256  # as constants; a lookup passes over those of its column


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation; constant columns give 0.

    Two numbers per column come back to the driver, as in any fitted scaler.
    """
    stats = (fit_on or df).agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()

    def scaled(c: str) -> F.Column:
        mean, spread = stats[f"m_{c}"], stats[f"s_{c}"]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(c) - mean) / (spread or 1.0)

    return df.withColumns({c: scaled(c) for c in cols})


def category_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(columna, valor): the distinct values of each column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("valor")) for c in cols]))
    return df.select(pairs.alias("v")).select("v.*").filter("valor IS NOT NULL").distinct()


def number_in_order(values: DataFrame) -> DataFrame:
    """Number each column's values in sorted order, however many there are.

    Values are range-partitioned and stored with the range they fell in; a window
    then ranges over one range, and over the few counts per range.
    """
    ranges = values.repartitionByRange("columna", "valor").withColumn("_range", F.spark_partition_id())
    stored = materialize(ranges, "categories")
    before = Window.partitionBy("columna").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("columna", "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("columna", "_range").orderBy("valor")
    numbered = stored.withColumn("_rank", F.row_number().over(within) - 1)
    code = (F.col("_offset") + F.col("_rank")).cast("int").alias("codigo")
    return numbered.join(offsets, ["columna", "_range"]).select("columna", "valor", code)


def category_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(columna, valor, codigo): each value's place in sorted order, from 0; stored."""
    return materialize(number_in_order(category_values(df, cols)), "category-codes")


def with_codes(
    df: DataFrame, cols: list[str], codes: DataFrame, prefix: str = "_code_", most: int = CONSTANT_CODES
) -> DataFrame:
    """Add the code of each column's value; values without one, and null, give -1.

    Up to ``most`` codes become constants of the plan, looked up without a join.  More
    are met by one join: values of all columns stand below one another, are joined with
    the codes as narrow rows, and their codes come back side by side.  A stream, whose
    rows cannot be numbered, is joined column by column.
    """
    few = codes.limit(most + 1).collect()
    if len(few) <= most:
        return _codes_as_constants(df, cols, few, prefix)
    return _codes_by_column(df, cols, codes, prefix) if df.isStreaming else _codes_by_one_join(df, cols, codes, prefix)


def _codes_as_constants(df: DataFrame, cols: list[str], codes: list[Row], prefix: str) -> DataFrame:
    def code(c: str) -> Column:
        pairs = [F.lit(x) for r in codes if r.columna == c for x in (r.valor, r.codigo)]
        return F.coalesce(F.create_map(*pairs)[F.col(c)], F.lit(-1)) if pairs else F.lit(-1)

    return df.withColumns({f"{prefix}{c}": code(c) for c in cols})


def _codes_by_one_join(df: DataFrame, cols: list[str], codes: DataFrame, prefix: str) -> DataFrame:
    # Numbers are stored with their rows, so a recomputed task cannot give others.
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-code")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("valor")) for c in cols]))
    found = rows.select("_row", values.alias("v")).select("_row", "v.*").join(codes, ["columna", "valor"])
    beside = found.groupBy("_row").agg(*[F.max(F.when(F.col("columna") == c, F.col("codigo"))).alias(f"{prefix}{c}") for c in cols])
    whole = rows.join(beside, "_row", "left").withColumns({f"{prefix}{c}": F.coalesce(f"{prefix}{c}", F.lit(-1)) for c in cols})
    return whole.select(*df.columns, *[f"{prefix}{c}" for c in cols])


def _codes_by_column(df: DataFrame, cols: list[str], codes: DataFrame, prefix: str) -> DataFrame:
    out = df
    for c in cols:
        own = codes.filter(F.col("columna") == c).select(F.col("valor").alias("_value"), F.col("codigo").alias("_found"))
        out = out.join(own, F.col(c) == F.col("_value"), "left").withColumn(f"{prefix}{c}", F.coalesce("_found", F.lit(-1)))
        out = out.drop("_value", "_found")
    return out


def index_categories(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace categories by their code in sorted order; unseen and null give -1."""
    coded = with_codes(df, cols, category_codes(fit_on or df, cols))
    return coded.select(*[F.col(f"_code_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
