"""What the operators share: tables, batch sizes, membership of keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conf import tune
from ..sources.scratch import materialize, ship

# Rows handed to Python at once; with bytes bounded too, a worker's memory does not
# follow the length of the texts.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
WHITESPACE = "[\\x20\\x09-\\x0D]+"  # the six ASCII white space characters


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the subpackage; what the session sets itself stays."""
    ship(spark)
    for key, value in ARROW.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return tune(spark)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Task) -> Task:
    """``run``, whose worker gives freed memory back as the task ends.

    Workers wait for further tasks, perhaps of another operator, and what they have
    freed but not returned would add up beside the executor's own memory.
    """

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(source)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def groups_of(texts: list[str | None], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Borders of runs of texts of together about ``most`` characters; a longer text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if size > most and i > start:
            yield start, i
            start, held = i, 0
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


# Bytes of a word: digits, letters in either case, all of a character beyond ASCII.
_WORD = bytes(c if (chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80) else 32 for c in range(128))
_MAP = bytes.maketrans(
    bytes(range(128)), bytes(c + 32 if 65 <= c <= 90 else _WORD[c] for c in range(128))
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only) of a text, in UTF-8."""
    return (text or "").encode().translate(_MAP).split()


# --- membership of keys in a set ------------------------------------------------------
#
# A Bloom filter in blocks: a key's hash picks a block of 32,768 bits and BITS places in
# it.  The number of blocks follows the number of keys, so false hits stay near one in
# sixty however many there are.  It is broadcast while its bytes, which are known
# before, are at most MOST_BYTES; beyond that, keys and rows are joined exactly.

BLOCK_BITS = 1 << 15  # of one row of a filter, as Spark's bitmap functions cut them
KEY_BITS = 12  # bits of the filter per key
BITS = 3  # places per key
BLOCK_BYTES = BLOCK_BITS // 8
LEAST_BLOCKS = 16  # 64 KB
MOST_BYTES = 256 << 20  # broadcast at most: 178 million keys


def _place(key: Column, i: int) -> Column:
    """The i-th place of a key in its block."""
    return F.xxhash64(F.lit(i), key).bitwiseAND(F.lit(BLOCK_BITS - 1))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


class Members:
    """Which keys are in a set: surely not, or perhaps (``exact``: surely).

    ``keys`` is a stored table with the long column ``key``; null keys are not members.
    """

    def __init__(self, keys: DataFrame, key: str, most_bytes: int = MOST_BYTES):
        self.keys = keys.select(F.col(key).alias("m_key")).filter("m_key IS NOT NULL")
        self.blocks = max(LEAST_BLOCKS, -(-self.keys.count() * KEY_BITS // BLOCK_BITS))
        self.exact = self.blocks * BLOCK_BYTES > most_bytes
        if not self.exact:
            places = F.explode(F.array(*[_place(F.col("m_key"), i) for i in range(BITS)])).alias("place")
            bits = F.bitmap_construct_agg("place").alias("m_bits")
            found = self.keys.select(_block(F.col("m_key"), self.blocks).alias("m_block"), places)
            # As longs, so that looking one up takes no text functions.
            half = lambda at: F.conv(F.hex(F.substring("m_bits", at, F.lit(4))), 16, 10).cast("long")
            word = lambda i: F.shiftleft(half(i * 8 + 1), 32).bitwiseOR(half(i * 8 + 5))
            words = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), word)
            self.filter = materialize(found.groupBy("m_block").agg(bits).select("m_block", words.alias("m_words")), "members")

    def mark(self, df: DataFrame, key: str | Column, name: str = "hit") -> DataFrame:
        """``df`` with the boolean column ``name``, never null."""
        value = F.col(key) if isinstance(key, str) else key
        if self.exact:
            there = self.keys.distinct().withColumn("m_hit", F.lit(True))
            out = df.withColumn("m_value", value).join(there, F.col("m_value") == F.col("m_key"), "left")
            return out.withColumn(name, F.coalesce("m_hit", F.lit(False))).drop("m_value", "m_key", "m_hit")
        out = df.withColumn("m_value", value)
        out = out.withColumn("m_of", _block(F.col("m_value"), self.blocks))
        out = out.join(F.broadcast(self.filter), F.col("m_of") == F.col("m_block"), "left")
        hit = F.col("m_value").isNotNull() & F.col("m_words").isNotNull()
        for i in range(BITS):  # the second and third place are looked at only where the first is set
            place = _place(F.col("m_value"), i).cast("int")
            word = F.get("m_words", F.shiftright(place, 6))
            # Bytes stand highest first in a number, bits lowest first in a byte.
            bit = (F.lit(7) - F.shiftright(place, 3).bitwiseAND(F.lit(7))) * 8 + place.bitwiseAND(F.lit(7))
            hit = hit & (F.getbit(word, bit) == 1)
        return out.withColumn(name, F.coalesce(hit, F.lit(False))).drop("m_value", "m_of", "m_block", "m_words")
