import random

from odd import ROWS, clashing_docs, no_docs

from claimflow.llm import chunks as C


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rolled(data):
    """The gear hash, byte by byte."""
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(C._GEAR[b])) % (1 << 32)
        out.append(h)
    return out


def brute(data):
    out, last, h = [], 0, rolled(data)
    space = b" \t\n\r\x0b\x0c"
    for end in range(1, len(data)):
        if data[end - 1] in space and data[end] not in space and h[end - 1] >> (32 - C.MASK_BITS) == 0:
            while end - last > C.MOST:
                last += C.MOST
                while data[last] & 0xC0 == 0x80:
                    last -= 1
                out.append(last)
            if end - last >= C.LEAST:
                out.append(end)
                last = end
    while len(data) - last > C.MOST:
        last += C.MOST
        while data[last] & 0xC0 == 0x80:
            last -= 1
        out.append(last)
    return out + [len(data)] if len(data) > last else out


def test_borders_equal_a_rolling_hash(monkeypatch):
    rng = random.Random(4)
    for text in ["", "a", "é" * 3000, sentence(rng, 900), " " * 50 + sentence(rng, 40) + " ", "x" * 5000 + " y"]:
        data = text.encode()
        assert C.borders(data) == brute(data)
        with monkeypatch.context() as m:
            m.setattr(C, "_BLOCK", 97)
            assert C.borders(data) == brute(data)


def test_borders_resist_insertions():
    rng = random.Random(5)
    passage = sentence(rng, 200).encode()
    ends = [{e - len(p) for e in C.borders(p + passage) if e > len(p)} for p in (b"", b"some words before ", sentence(rng, 33).encode() + b" ")]
    assert len(ends[0] & ends[1] & ends[2]) > 0.85 * len(ends[0])


def unspaced(rng, n):
    return "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))


def test_unspaced_borders_resist_insertions(monkeypatch):
    rng = random.Random(9)
    for passage in (unspaced(rng, 2000), "".join(rng.choice("abcdefgh(){};=") for _ in range(4000))):
        data = passage.encode()
        ends = [{e - len(p) for e in C.borders(p + data) if e > len(p)} for p in (b"", "字".encode(), unspaced(rng, 333).encode())]
        assert len(ends[0]) > 40 and len(ends[0] & ends[1] & ends[2]) > 0.85 * len(ends[0])
        assert all(data[e : e + 1].decode("latin-1") < "\x80" or data[e] & 0xC0 != 0x80 for e in ends[0])
        whole = C.borders(data)
        with monkeypatch.context() as m:
            m.setattr(C, "_BLOCK", 97)
            assert C.borders(data) == whole


def test_unspaced_passages_go(spark):
    rng = random.Random(10)
    passage = unspaced(rng, 300)  # 900 bytes: less than the largest chunk
    rows = [(0, unspaced(rng, 100) + passage + unspaced(rng, 90)), (1, unspaced(rng, 457) + passage + unspaced(rng, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in C.substring_dedup(docs).collect()}
    assert got[0] == rows[0][1] and len(got[1]) < len(rows[1][1]) - 200
    assert got[1].startswith(rows[1][1][:457]) and got[1].endswith(rows[1][1][-20:])


def test_passages_across_documents(spark):
    rng = random.Random(6)
    rows, passage = [], {}
    for k in range(40):
        passage[k] = sentence(rng, 55)
        for j in range(2):
            rows.append((2 * k + j, f"{sentence(rng, rng.randint(30, 90))} {passage[k]} {sentence(rng, 60)}"))
    clean = [(1000 + i, sentence(rng, 200)) for i in range(40)]
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in C.substring_dedup(docs).collect()}
    for key, text in clean:
        assert got[key] == text
    for key, text in rows:
        if key % 2 == 0:
            assert got[key] == text  # the first stays
        else:
            assert passage[key // 2] not in got[key] and len(got[key]) < len(text) - C.LEAST_RUN
            assert text.startswith(got[key][:100]) and text.endswith(got[key][-100:])


def test_odd_rows(spark):
    docs = clashing_docs(spark)
    out = C.substring_dedup(docs, least_run=30)
    assert out.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(rows) == len(ROWS)
    got = dict(rows)
    assert got[1] == ROWS[0][1] and got[5] is None and got[6] == "" and got[7] == ROWS[7][1] and got[10] == ROWS[10][1]
    assert [t for k, t in rows if k == 2] == ["", ""]  # equal rows, equal results
    assert C.substring_dedup(no_docs(spark)).collect() == []


def test_runs():
    spans = [{"lo": 0, "hi": 50}, {"lo": 50, "hi": 90}, {"lo": 100, "hi": 130}]
    assert C.runs_of(spans, 60) == [(0, 90)] and C.runs_of(None, 1) == []
