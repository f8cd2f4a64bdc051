"""Column expressions over text.

All stay in the JVM.  Cheap string functions are used where they say the same as
a pattern; a pattern is left only where text really has to be parsed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import PRICE_DEFAULT, PRICE_MIDPOINTS


def strip_breaks(col: Column) -> Column:
    """Delete line breaks anywhere, then trim spaces (tabs stay).

    Plain replacements hand the value back untouched where there is nothing to
    delete, which is nearly always.
    """
    for line_break in ("\r", "\n"):
        col = F.replace(col, F.lit(line_break), F.lit(""))
    return F.trim(col)


def lenient_int(col: Column) -> Column:
    """Text to int the lenient way: bad text is null, decimals are cut off.

    ``try_cast`` decides nearly every row; the pattern runs only where it gave
    null.
    """
    whole = F.regexp_extract(col, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(col.try_cast("int"), whole.try_cast("int"))


def split_part(col: Column, separator: str, index: int) -> Column:
    """The index-th piece of a split, null past the end.

    Searched for as plain text: ``split`` would compile a pattern for each row.
    """
    for _ in range(index):
        rest = F.substr(col, F.instr(col, separator) + len(separator))
        col = F.when(F.contains(col, F.lit(separator)), rest)
    return F.substring_index(col, separator, 1)


def lookup(col: Column, values: dict[str, str] | dict[str, float]) -> Column:
    """Value of a key in a constant map, null if absent.

    A map literal keeps the generated code small however many keys it has; a
    CASE branch per key would grow it beyond what the JVM compiles.
    """
    literals = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*literals), col)


def translate_value(col: Column, dictionary: dict[str, str]) -> Column:
    """Replace known values; anything else, null too, passes through."""
    return F.coalesce(lookup(col, dictionary), col)


def ordinal(col: Column, values: dict[str, int], default: int) -> Column:
    """Rank of a known value, ``default`` for unknown or null (double)."""
    return F.coalesce(lookup(col, {k: float(v) for k, v in values.items()}), F.lit(float(default)))


def price_midpoint(col: Column) -> Column:
    """Price-band text to its estimate; the first matching band wins."""
    out = None
    for phrase, estimate in PRICE_MIDPOINTS:
        # Only the two open-ended phrases ignore case.
        text = col if phrase[0].isdigit() else F.lower(col)
        hit = F.contains(text, F.lit(phrase))
        out = F.when(hit, estimate) if out is None else out.when(hit, estimate)
    return out.otherwise(PRICE_DEFAULT)


def range_lower_bound(col: Column, allow_scalar: bool = False) -> Column:
    """``none`` -> 0, ``more than n`` -> n + 1, ``a to b`` -> a, else null.

    The tests for ``none`` and ``more than`` ignore case, the extraction does
    not, so ``More than 30`` is null.  ``allow_scalar`` also takes bare digits.
    """
    above = F.regexp_extract(col, r"more than (\d+)", 1).try_cast("int")
    lower = F.regexp_extract(col, r"(\d+) to", 1).try_cast("int")
    out = (
        F.when(F.lower(col) == "none", 0)
        .when(col.rlike(r"(?i)more than \d"), F.try_add(above, F.lit(1)))
        .when(col.rlike(r"\d to \d"), lower)
    )
    if allow_scalar:
        out = out.when(col.rlike(r"^\d+$"), col.try_cast("int"))
    return out


def iso_week(col: Column) -> Column:
    """ISO week (1-53) of ``YYYY-MM-DD`` text, zeros optional; null if it is no date."""
    return F.weekofyear(F.try_to_date(col, "yyyy-M-d"))


def week_of_month(col: Column) -> Column:
    """Week within the month (1-5, days 1-7 are week 1) of ``YYYY-MM-DD`` text; null if it is no date."""
    return (F.floor((F.dayofmonth(F.try_to_date(col, "yyyy-M-d")) - 1) / 7) + 1).cast("int")
