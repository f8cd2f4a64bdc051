import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import clashing_docs, no_docs
from tokenizers import Tokenizer

from claimflow.llm import shards as S

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 5000), key=st.integers(0, 1 << 64))
def test_permutation(n, key):
    p = S.Permutation(n, key)
    slots = p.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert p.sequence(slots).tolist() == list(range(n))


def test_keys_give_other_orders():
    a, b = (S.Permutation(1000, k).slot(np.arange(1000)) for k in (1, 2))
    assert (a != b).mean() > 0.9


def test_shards_hold_the_stream_in_the_order_of_the_key(spark, tmp_path):
    docs = clashing_docs(spark)
    path, length, per_shard = f"file://{tmp_path}/shards", 64, 100
    count = S.write_shards(docs, path, PATH, key=9, length=length, per_shard=per_shard)
    tokenizer = Tokenizer.from_file(PATH)
    texts = [r["text"] for r in docs.collect()]  # the order of the rows
    stream = [i for t in texts for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, S.END]]
    assert count == -(-len(stream) // length) and S.id_type(PATH) == np.dtype("<u2")
    stream = np.array(stream + [S.PAD] * (count * length - len(stream)), S.id_type(PATH)).reshape(count, length)
    slots = S.Permutation(count, 9).slot(np.arange(count))
    rows = S.read_shards(spark, path, count, 9, per_shard).collect()
    assert sorted(r["slot"] for r in rows) == list(range(count))
    for r in rows:
        assert slots[r["sequence"]] == r["slot"] and r["shard"] == r["slot"] // per_shard
        assert r["ids_crc32"] == zlib.crc32(stream[r["sequence"]].tobytes())
    for sequence in (0, count // 2, count - 1):
        assert S.read_slot(path, int(slots[sequence]), per_shard).tolist() == stream[sequence].tolist()
    names = sorted(p.name for p in (tmp_path / "shards").iterdir())
    assert names == [f"shard-{k:08d}.bin" for k in range(-(-count // per_shard))]


def test_empty_table(spark, tmp_path):
    assert S.write_shards(no_docs(spark), f"file://{tmp_path}/none", PATH, key=1) == 0


def test_second_attempt_replaces_a_shard(spark, tmp_path):
    from pyarrow import fs

    class Strict(fs.SubTreeFileSystem):
        """Like storages that refuse to move over a file."""

        def move(self, a, b):
            assert self.get_file_info(b).type == fs.FileType.NotFound
            super().move(a, b)

    files = Strict(str(tmp_path), fs.LocalFileSystem())
    for attempt in (1, 2):
        with files.open_output_stream(f"x.{attempt}") as out:
            out.write(b"same bytes")
        S._put(files, f"x.{attempt}", "x")
    assert [p.name for p in tmp_path.iterdir()] == ["x"] and (tmp_path / "x").read_bytes() == b"same bytes"
    path = f"file://{tmp_path}/shards"
    for _ in range(2):  # a whole run over what another has left
        count = S.write_shards(clashing_docs(spark), path, PATH, key=9, length=64, per_shard=100)
        assert S.read_shards(spark, path, count, 9, 100).count() == count
