"""Column expressions over numbers: differences, scores, bands, rounding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import ALERT_LEVELS


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def clamped_diff(later: Column, earlier: Column) -> Column:
    """later - earlier, not below 0; null if either side is null."""
    diff = later - earlier
    # greatest() would skip a null diff, hence the guard.
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0)))


def additive_score(signals: Sequence[Column]) -> Column:
    """Number of signals that hold; unknown ones count 0."""
    return reduce(add, [flag(s) for s in signals])


def weighted_score(weights: dict[str, int]) -> Column:
    """Weighted sum of numeric columns."""
    return reduce(add, [F.col(name) * weight for name, weight in weights.items()])


def bucket_label(
    col: Column,
    bands: Sequence[tuple[float | None, str]],
    closed: bool,
    exact: dict[float, str] | None = None,
) -> Column:
    """Label of an exact value, else of the first band whose edge is not passed.

    ``closed`` says whether a value on the edge still belongs to the band.  The
    last band has edge None and takes the rest; null stays null.
    """
    out = F.when(col.isNull(), F.lit(None).cast("string"))
    for value, label in (exact or {}).items():
        out = out.when(col == value, label)
    for edge, label in bands:
        if edge is None:
            return out.otherwise(label)
        out = out.when(col <= edge if closed else col < edge, label)
    return out


def alert_level(p: Column) -> Column:
    """Alert of an unrounded probability in [0, 1]; null outside it."""
    out = F.when((p < 0) | (p > ALERT_LEVELS[-1][0]) | F.isnan(p), F.lit(None).cast("string"))
    for edge, label in ALERT_LEVELS:
        out = out.when(p <= edge, label)
    return out


def round_scaled_even(col: Column, digits: int) -> Column:
    """Scale, round half to even, scale back (the NumPy array rounding)."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def fixed_text(col: Column, digits: int) -> Column:
    """Fixed-point text of the exact binary value (as C's ``%.nf``)."""
    return F.call_function("format_number", col, F.lit("0." + "0" * digits))


def round_exact(col: Column, digits: int) -> Column:
    """Correct rounding of the exact binary value, true ties to even."""
    return fixed_text(col, digits).cast("double")
