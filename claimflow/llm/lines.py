"""Line dedup (native): exact and near repeats of lines, by a deletion-neighbourhood join.

Lines are compared as words in lower case, split at ASCII white space.  Two lines, the
longer of at least MIN_WORDS words, repeat one another if one word inserted, deleted or
replaced makes them equal; two shorter ones, both of at least MIN_CHARS characters, if
one character does.  The earliest line of the corpus, by document key, text hash and
place, stays; a line is dropped if any earlier line, kept or not, is that near.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporaries
from .common import Members

MIN_WORDS = 8  # of the longer of two lines that are compared by words
MIN_CHARS = 16  # of the shorter of two lines that are compared by characters
WHITE = " \t\n\x0b\x0c\r"
LINE = ["h", "h2", "nw"]  # what identifies a line: 96 bits of its words, and their number


@dataclass(frozen=True)
class Form:
    """What a line is a sequence of where it is compared: words of an array, or characters of a text."""

    name: str
    column: str
    shorter: int  # least size of the shorter line of a pair
    equal: int  # least size of two lines that differ by a replacement

    def cut(self, line: Column, start: Column, n: Column) -> Column:
        return F.slice(line, start, n) if self.name == "words" else F.substring(line, start, n)

    def size(self, line: Column) -> Column:
        return F.size(line) if self.name == "words" else F.length(line)

    def near(self, a: Column, b: Column) -> Column:
        """One unit inserted, deleted or replaced turns ``a`` into ``b``."""
        return _is_near(a, b) if self.name == "words" else F.levenshtein(a, b, 1) == 1


WORDS = Form("words", "words", MIN_WORDS - 1, MIN_WORDS)
CHARS = Form("chars", "chars", MIN_CHARS, MIN_CHARS)


def _chars(words: Column) -> Column:
    """The line as text, if it is compared by characters; else null."""
    text = F.array_join(words, " ")
    return F.when((F.size(words) < MIN_WORDS) & (F.length(text) >= MIN_CHARS), text)


def _words(line: Column) -> Column:
    """Words in lower case.  Few lines hold white space but spaces; only those are translated."""
    other = "\t\x0b\x0c\r"
    odd = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in other])
    spaced = F.when(odd, F.translate(line, other, " " * len(other))).otherwise(line)
    return F.array_remove(F.split(F.lower(spaced), " "), "")


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per line that has words: where it stands, and its content."""
    rows = docs.select(
        F.col(key).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(F.col(text), "\n")).alias("line", "content")
    )
    # On the content, so that the filter needs no words; pushed down, they would be cut twice.
    # Trimming ends at the first other character and decodes nothing, as a pattern would.
    return rows.filter(F.ltrim("content", F.lit(WHITE)) != "")


def _worded(lines: DataFrame) -> DataFrame:
    """Lines with their words and what identifies them."""
    return lines.select("id", "th", "line", _words(F.col("content")).alias("words")).select(
        "id", "th", "line", F.xxhash64("words").alias("h"), F.hash("words").alias("h2"), F.size("words").alias("nw"), "words"
    )


def _spots(docs: DataFrame, text: str, key: str, at: DataFrame) -> DataFrame:
    """The lines at the places ``at`` (struct ``first``), and perhaps a few more, with their words.

    Filters over rows and places keep all other documents and lines from being cut
    into words again.
    """
    row, place = F.xxhash64("first.id", "first.th"), F.xxhash64("first.id", "first.th", "first.line")
    rows = Members(at.select(row.alias("k")).distinct(), "k").mark(docs.select(key, text), F.xxhash64(F.col(key), F.xxhash64(text)))
    found = _lines(rows.filter("hit").drop("hit"), text, key)
    return _worded(Members(at.select(place.alias("k")), "k").mark(found, F.xxhash64("id", "th", "line")).filter("hit"))


def _half_keys(form: Form, line: Column, size: Column, shorter: Column) -> list[Column]:
    """Hashes of the first and of the last half that a pair shares, one of which one edit leaves whole.

    ``shorter`` is the size of the shorter line of the pair.
    """
    half = F.floor(shorter / 2).cast("int")
    first = F.xxhash64(F.lit(f"first {form.name}"), shorter, form.cut(line, F.lit(1), half))
    last = F.xxhash64(F.lit(f"last {form.name}"), shorter, form.cut(line, size - (shorter - half) + 1, shorter - half))
    return [first, last]


def _keys(form: Form, line: Column) -> Column:
    """The four half keys of a line: with its own size, and as the longer of a pair; null if it has none."""
    n = form.size(line)
    own = [F.when(n >= form.shorter, k) for k in _half_keys(form, line, n, n)]
    long = [F.when(n > form.shorter, k) for k in _half_keys(form, line, n, n - 1)]
    return F.when(n >= form.shorter, F.array(*own, *long))


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


# A sequence is hashed as the exclusive or of the hashes of its units with their places, so
# the hash without a place follows from that of the whole.  ``here`` has the hashes of
# the units at their places, ``back`` at the places before them, ``all_here`` and
# ``all_back`` the exclusive ors of all.


def _placed(units: Column, shift: int) -> Column:
    return F.transform(units, lambda u, i: F.xxhash64(i - shift, u))


def _replaced(form: Form, n: Column, low: Column, high: Column) -> Column:
    """Keys of a line with one of the places low..high-1 left out; lines that differ there alone share it."""
    key = lambda i: F.xxhash64(F.lit(f"replace {form.name}"), n, i, F.col("all_here").bitwiseXOR(F.get("here", i)))
    return _places(low, high, key)


def _shortened(form: Form, n: Column, low: Column, high: Column) -> Column:
    """Keys of a line without one of the units low..high-1: those of the shorter line that is left."""

    def key(i: Column) -> Column:
        # Units behind the place move up by one.
        moved = F.zip_with(F.slice("here", F.lit(1), i), F.slice("back", F.lit(1), i), lambda x, y: x.bitwiseXOR(y))
        rest = F.col("all_back").bitwiseXOR(F.get("back", i)).bitwiseXOR(_xor(moved))
        return F.xxhash64(F.lit(f"shift {form.name}"), n - 1, rest)

    return _places(low, high, key)


def _places(low: Column, high: Column, key) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(high > low, F.transform(F.sequence(low, high - 1), key)).otherwise(none)


def _is_near(a: Column, b: Column) -> Column:
    """One word inserted, deleted or replaced turns the words ``a`` into ``b``."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: ~e)) == 1
    long, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    cut = F.exists(
        F.sequence(F.lit(0), F.size(short)), lambda i: F.concat(F.slice(long, F.lit(1), i), F.slice(long, i + 2, F.size(long))) == short
    )
    return F.when(F.size(a) == F.size(b), same).when(F.abs(F.size(a) - F.size(b)) == 1, cut).otherwise(False)


def _variants(worded: DataFrame) -> DataFrame:
    """(form, kind, line, k): the hashed variants of each line, whose units are hashed once for all kinds.

    A place before the half can only differ if the last halves are shared.
    """
    units = F.when(F.col("form") == WORDS.name, F.col("words")).otherwise(F.split("chars", ""))
    hashed = worded.select("form", "first", *LINE, "n", "r0", "r1", "s", "l0", "l1", _placed(units, 0).alias("here"), _placed(units, 1).alias("back"))
    hashed = hashed.select("*", _xor(F.col("here")).alias("all_here"), _xor(F.col("back")).alias("all_back"))
    n, none = F.col("n"), F.array().cast("array<bigint>")
    half, half_long = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    variants = []
    for form in (WORDS, CHARS):
        kinds = {
            "replace": F.concat(
                F.when(F.col("r0"), _replaced(form, n, half, n)).otherwise(none),
                F.when(F.col("r1"), _replaced(form, n, F.lit(0), half)).otherwise(none),
            ),
            "longer": F.array_distinct(
                F.concat(
                    F.when(F.col("l0"), _shortened(form, n, half_long, n)).otherwise(none),
                    F.when(F.col("l1"), _shortened(form, n, F.lit(0), half_long)).otherwise(none),
                )
            ),
            "shorter": F.when(F.col("s"), F.array(F.xxhash64(F.lit(f"shift {form.name}"), n, F.col("all_here")))).otherwise(none),
        }
        by_kind = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), keys.alias("k")) for kind, keys in kinds.items()]))
        own = hashed.filter(F.col("form") == form.name).select("form", F.struct("first", *LINE).alias("line"), by_kind.alias("of"))
        variants.append(own.select("form", "of.kind", "line", F.explode("of.k").alias("k")))
    return reduce(DataFrame.union, variants)


def _near_lines(docs: DataFrame, text: str, key: str, unique: DataFrame) -> DataFrame:
    """The lines (LINE) that have an earlier line within one edit."""
    # 1: which halves are shared, with own size (o) or as the longer of a pair (l).
    forms = [
        unique.filter(F.col(f"k_{f.name}").isNotNull()).select(*LINE, "first", F.lit(f.name).alias("form"), F.col(f"k_{f.name}").alias("k4"), n)
        for f, n in ((WORDS, F.col("nw").alias("n")), (CHARS, F.col("nc").alias("n")))
    ]
    keyed = forms[0].union(forms[1])
    halves = keyed.select(F.posexplode("k4").alias("i", "k")).filter("k IS NOT NULL")
    own, long = F.count_if(F.col("i") < 2).alias("o"), F.count_if(F.col("i") > 1).alias("l")
    shared = materialize(halves.groupBy("k").agg(own, long).filter("o > 1 OR o * l > 0"), "line-halves")
    replaced, shifted = Members(shared.filter("o > 1"), "k"), Members(shared.filter("o * l > 0"), "k")

    # 2: lines with a shared half, and on which side an edit can then lie.
    tested = keyed
    for name, members, i in [("r0", replaced, 0), ("r1", replaced, 1), ("s0", shifted, 0), ("s1", shifted, 1), ("l0", shifted, 2), ("l1", shifted, 3)]:
        tested = members.mark(tested, F.col("k4")[i], name)
    equal = F.when(F.col("form") == WORDS.name, F.col("n") >= WORDS.equal).otherwise(F.col("n") >= CHARS.equal)
    tested = tested.withColumns({"r0": F.col("r0") & equal, "r1": F.col("r1") & equal, "s": F.col("s0") | F.col("s1")})
    active = materialize(
        tested.filter("r0 OR r1 OR s OR l0 OR l1").select(*LINE, "first", "form", "n", "r0", "r1", "s", "l0", "l1"), "line-active"
    )
    # 3: their words, read again at the place where each line stands first.
    places = _spots(docs, text, key, active)
    at_first = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "line")
    found = active.join(places.withColumn("at", at_first), LINE).filter(F.col("at") == F.col("first"))
    worded = materialize(
        found.dropDuplicates([*LINE, "form"]).withColumn("chars", _chars(F.col("words"))).drop("id", "th", "line", "at"), "line-words"
    )
    # 4: hashed variants.
    variants = materialize(_variants(worded), "line-variants")
    # 5: join equal variants with the earliest line of the other side; a key held by
    # many lines gives each of them one partner, not all.
    shorter = F.col("kind") == "shorter"
    anchors = materialize(
        variants.groupBy("k")
        .agg(F.min(F.when(~shorter, F.col("line"))).alias("a"), F.min(F.when(shorter, F.col("line"))).alias("b"), F.count("*").alias("n"))
        .filter("n > 1"),
        "line-anchors",
    )
    partner = F.when(F.col("kind") == "longer", F.col("b")).otherwise(F.col("a"))
    pairs = variants.join(anchors, "k").select("form", "line", partner.alias("other")).filter("other.first < line.first").distinct()
    # 6: verify on the words or characters.
    sides = {}
    for side in ("a", "b"):
        columns = [F.col(c).alias(f"{side}_{c}") for c in ("words", "chars")]
        sides[side] = worded.select("form", *[F.col(c).alias(f"{side}_{c}") for c in LINE], *columns)
    pairs = pairs.select("form", *[F.col(f"{s}.{c}").alias(f"{p}_{c}") for s, p in (("line", "a"), ("other", "b")) for c in LINE])
    for side, rows in sides.items():
        pairs = pairs.join(rows, ["form", *[f"{side}_{c}" for c in LINE]])
    by_words, by_chars = (f.near(F.col(f"a_{f.column}"), F.col(f"b_{f.column}")) for f in (WORDS, CHARS))
    near = F.when(F.col("form") == WORDS.name, by_words).otherwise(by_chars)
    return pairs.filter(near).select(*[F.col(f"a_{c}").alias(c) for c in LINE]).distinct()


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, th, gone): per row key and text hash, the sorted numbers (from 0) of the lines to drop."""
    worded = _worded(_lines(docs, text, key)).withColumn("chars", _chars(F.col("words")))
    lines = materialize(
        worded.select(
            "id", "th", "line", *LINE, F.length("chars").alias("nc"),
            _keys(WORDS, F.col("words")).alias("k_words"), _keys(CHARS, F.col("chars")).alias("k_chars"),
        ),
        "lines",
    )
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "line")
    unique = materialize(
        lines.groupBy(*LINE).agg(F.min(at).alias("first"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("nc", "k_words", "k_chars")]),
        "lines-unique",
    )
    near = _near_lines(docs, text, key, unique).withColumn("near", F.lit(True))
    flagged = materialize(
        unique.select(*LINE, "first", "n").join(near, LINE, "left").filter("n > 1 OR near").select(*LINE, "first", "near"), "lines-flagged"
    )
    # Two stored tables: a line that a third of all lines repeat is split at run time.
    gone = lines.select("id", "th", "line", *LINE).join(flagged, LINE).filter(F.col("near") | (at != F.col("first")))
    return gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("line")).alias("gone"))


def with_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, n_lines, n_dropped, rest) per row of ``docs``: the row as a struct, and its text without repeated lines."""
    with temporaries(docs.sparkSession):
        gone = materialize(repeated_lines(docs, text, key), "lines-gone", keep=True)
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("r_id"), F.xxhash64(text).alias("r_th"))
    rows = rows.join(gone, F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_th") == F.col("th")), "left")
    body = F.col("doc")[text]
    # The text is cut once per row, then the lines that stay are picked by number.
    cut = F.transform(
        F.array(F.split(body, "\n")),
        lambda lines: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i)), "\n"
        ),
    )[0]
    return rows.select(
        "doc",
        F.coalesce(F.size(F.split(body, "\n")), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_dropped"),
        F.when(F.col("gone").isNull(), body).otherwise(cut).alias("rest"),
    )


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the columns it has, without repeated lines in the text.

    Lines without words stay.  With ``drop_emptied`` rows go that had words and have
    none left.  Nulls: a null text has no lines and stays null; null keys come after
    all others.  Rows equal in key and text count as one and keep the same lines.  A
    text of many lines is one row throughout; extra columns travel inside a struct, so
    no name can clash.  An empty table gives an empty result.
    """
    done = with_repeats(docs, text, key)
    if drop_emptied:
        done = done.filter((F.col("n_dropped") == 0) | F.col("rest").rlike("[^\\x20\\x09-\\x0D]"))
    return done.select(*[F.col("rest").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
