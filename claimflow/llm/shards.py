"""Token sequences in training order, as binary shards of fixed stride.

The ids of all documents form one stream, cut into sequences of equal length.  A
keyed permutation of the sequence numbers gives each its slot in training order.
Slots are cut into shards; in a shard, the record of a slot stands at a byte place
that follows from the slot alone, so training reads on from any step by seeking.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize, scratch_path
from .common import groups_of, tidy
from .tokens import tokenizer

LENGTH = 1024  # ids of a sequence
PER_SHARD = 4096  # sequences of a shard: 8 MB of two-byte ids
RANGE_SHARDS = 32  # shards that one task writes, at most
END = 1  # the id after every document
PAD = 0  # fills the last sequence
_HEAD = "<8sIIQQ"  # magic, ids of a record, bytes of an id, first slot, records
_HEAD_SIZE = struct.calcsize(_HEAD)
_MAGIC = b"TOKSHRD1"
_STREAM = "part int, start long, n long, ids binary"


def id_type(tokenizer_path: str) -> np.dtype:
    """Two bytes an id where the vocabulary fits, else four; little-endian."""
    return tokenizer(tokenizer_path).kind


class Permutation:
    """A keyed permutation of 0..n-1: Feistel rounds on the next even power of two, walking back into range."""

    ROUNDS = 6

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, -(-max(1, n - 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64)) for r in range(self.ROUNDS)]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(self.half), x & self.mask
        for key in self.keys:
            a, b = b, a ^ self._mix(b, key)
        return (a << np.uint64(self.half)) | b

    def _back(self, x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(self.half), x & self.mask
        for key in reversed(self.keys):
            a, b = b ^ self._mix(a, key), a
        return (a << np.uint64(self.half)) | b

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, np.uint64))
        while (out := x >= self.n).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, self._once)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


def _streams(docs: DataFrame, tokenizer_path: str, text: str, kind: np.dtype) -> DataFrame:
    """(part, start, n, ids) per document: its place in the stream of its task."""
    end = np.array([END], kind).tobytes()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(tokenizer_path)
        part, at = TaskContext.get().partitionId(), 0
        for batch in source:
            texts = batch.column("t").to_pylist()
            for lo, hi in groups_of(texts):
                codes = [code + end for code in words.encode(texts[lo:hi])]
                n = np.array([len(c) // kind.itemsize for c in codes])
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(start), pa.array(n), pa.array(codes, pa.binary())],
                    names=["part", "start", "n", "ids"],
                )
        words.rest()

    return docs.select(F.col(text).alias("t")).mapInArrow(tidy(run), _STREAM)


def _put(files, made: str, name: str) -> None:
    """Give a written file its name; one that an earlier attempt has left there is replaced."""
    from pyarrow import fs

    if files.get_file_info(name).type == fs.FileType.File:
        files.delete_file(name)  # not every storage moves over a file that is there
    files.move(made, name)


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    key: int,
    text: str = "text",
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
) -> int:
    """Write the sequences of ``docs`` below ``path``, a URI that every executor reaches; their number.

    Documents follow one another in the order of their rows; each ends with the end
    id, and the last sequence is filled up with the pad id.  The tokens move once, to
    the range of slots they belong to.  A shard is written under a name of the attempt
    and then moved, so a repeated task replaces it by the same bytes.

    Null and empty texts are the end id alone; other columns do not matter.  Very long
    texts are encoded in slices and span many sequences.  Repeated rows are written as
    often as they come.  An empty table writes nothing.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer_path)
    width = kind.itemsize
    # The ids are stored once and moved once, both times compressed: less disk than the shards.
    held = scratch_path(spark, "token-streams")
    _streams(docs, tokenizer_path, text, kind).write.option("compression", "zstd").parquet(held)
    streams = spark.read.schema(_STREAM).parquet(held)
    sums = streams.groupBy("part").agg(F.max(F.col("start") + F.col("n")).alias("n")).orderBy("part").collect()  # one per task
    base, total = {}, 0
    for row in sums:
        base[row["part"]] = total
        total += row["n"]
    if not total:
        return 0
    count = -(-total // length)
    permutation = Permutation(count, key)
    shared = spark.sparkContext.broadcast(base)

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as the parts of sequences that they fill, compressed."""
        base, compress = shared.value, zstandard.ZstdCompressor(1).compress
        for batch in source:
            seqs, places, parts = [], [], []
            for part, start, ids in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), batch.column("ids")):
                at, data = base[part] + start, memoryview(ids.as_py())
                done = 0
                while done < len(data):
                    seq, place = divmod(at + done // width, length)
                    more = min(len(data) - done, (length - place) * width)
                    seqs.append(seq)
                    places.append(place)
                    parts.append(compress(data[done : done + more]))
                    done += more
            if seqs:
                slot = permutation.slot(np.array(seqs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot // per_shard), pa.array(slot), pa.array(places, pa.int32()), pa.array(parts, pa.binary())],
                    names=["shard", "slot", "place", "ids"],
                )

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        attempt, expand = TaskContext.get().taskAttemptId(), zstandard.ZstdDecompressor().decompress
        out, now, record, slot_now = None, None, bytearray(), None
        done: list[tuple[int, int]] = []

        def close_record():
            if slot_now is not None:
                out.write(bytes(record).ljust(length * width, PAD_BYTES))

        def close_shard():
            if out is not None:
                close_record()
                out.close()
                _put(files, f"{folder}/shard-{now:08d}.bin.{attempt}", f"{folder}/shard-{now:08d}.bin")
                done.append((now, min(per_shard, count - now * per_shard)))

        for batch in source:
            for shard, slot, ids in zip(batch.column("shard").to_pylist(), batch.column("slot").to_pylist(), batch.column("ids")):
                if shard != now:
                    close_shard()
                    now, slot_now = shard, None
                    out = files.open_output_stream(f"{folder}/shard-{now:08d}.bin.{attempt}")
                    first = now * per_shard
                    out.write(struct.pack(_HEAD, _MAGIC, length, width, first, min(per_shard, count - first)))
                if slot != slot_now:
                    close_record()
                    record, slot_now = bytearray(), slot
                record += expand(ids.as_py())
        close_shard()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], names=["shard", "records"])

    placed = streams.select("part", "start", "ids").mapInArrow(cut, "shard long, slot long, place int, ids binary")
    # Slots are spread evenly, so equal runs of shards are ranges of equal size: nothing is sampled.
    n_shards = -(-count // per_shard)
    ranges = min(n_shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_shards // RANGE_SHARDS)))
    of = F.floor(F.col("shard") * ranges / n_shards).cast("int")
    ranged = placed.repartitionById(ranges, of).sortWithinPartitions("slot", "place")
    written = materialize(ranged.mapInArrow(write, "shard long, records long"), "token-shards")
    if written.agg(F.sum("records")).first()[0] != count:
        raise RuntimeError("not all sequences were written")
    return count


PAD_BYTES = b"\0"  # PAD, byte by byte


def read_shards(spark: SparkSession, path: str, count: int, key: int, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, sequence, shard, byte_offset, ids_crc32) of every record, read back from the files."""
    permutation = Permutation(max(1, count), key)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for content in batch.column("content"):
                data = memoryview(content.as_buffer())
                magic, length, size, first, n = struct.unpack_from(_HEAD, data)
                if magic != _MAGIC or len(data) != _HEAD_SIZE + n * length * size:
                    raise ValueError("not a whole shard")
                at = _HEAD_SIZE + np.arange(n) * length * size
                slot = first + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slot),
                        pa.array(permutation.sequence(slot)),
                        pa.array(np.full(n, first // per_shard)),
                        pa.array(at),
                        pa.array([zlib.crc32(data[a : a + length * size]) for a in at.tolist()], pa.int64()),
                    ],
                    names=["slot", "sequence", "shard", "byte_offset", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").load(f"{path}/shard-*.bin").select("content")
    return files.mapInArrow(run, "slot long, sequence long, shard long, byte_offset long, ids_crc32 long")


def read_slot(path: str, slot: int, per_shard: int = PER_SHARD) -> np.ndarray:
    """The ids of one slot, by seeking: where a resumed run reads on."""
    from pyarrow import fs

    files, folder = fs.FileSystem.from_uri(path)
    with files.open_input_file(f"{folder}/shard-{slot // per_shard:08d}.bin") as f:
        _, length, size, first, _ = struct.unpack(_HEAD, f.read(_HEAD_SIZE))
        f.seek(_HEAD_SIZE + (slot - first) * length * size)
        return np.frombuffer(f.read(length * size), f"<u{size}")
