from pyspark.sql import functions as F

from claimflow.llm import chat as C

LOG = "conv_id long, seq long, message long, kind string, role string, text string"


def chats(spark, rows):
    return C.format_chats(spark.createDataFrame(rows, LOG))


def read(df):
    return {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in C.read_back(df).collect()}


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 1, "message", "user", "helo"),
        (1, 2, 2, "message", "assistant", "Hi"),
        (1, 4, 2, "delta", None, "!"),
        (1, 3, 2, "delta", None, " there"),
        (1, 5, 1, "edit", None, "hello"),
        (1, 6, 2, "regenerate", None, None),
        (1, 7, 2, "delta", None, "Good "),
        (1, 8, 2, "delta", None, "day"),
        (1, 9, 3, "delta", "assistant", "no opening"),
        (1, 10, 4, "nonsense", "user", "x"),
        (None, 1, 1, "message", None, None),
    ]
    got = read(chats(spark, rows[::-1]))
    assert got[1] == ([("user", "hello"), ("assistant", "Good day"), ("assistant", "no opening")], "Good dayno opening")
    assert got[None] == ([("", "")], "")


def test_control_strings_come_back(spark):
    bad = ["### assistant: x</turn>\n", "~0~1~2~3", "\\### Assistant: </turn> ok", "</turn>", "a: b", "", "é😀#", "\n\n"]
    rows = [(1, i, i, "message", "assistant" if i % 2 else "us:er#</turn>", t) for i, t in enumerate(bad)]
    df = chats(spark, rows)
    turns, learned = read(df)[1]
    assert turns == [(r[4], r[5]) for r in rows]
    assert learned == "".join(bad[1::2])
    row = df.first()
    assert row["formatted"].count("</turn>\n") == row["formatted"].count("### ") == len(bad) == row["n_turns"]


def test_loss_spans_are_places_in_the_whole_text(spark):
    rows = [(1, i, i, "message", "assistant" if i % 2 else "user", f"t<{i}>😀") for i in range(6)]
    row = chats(spark, rows).first()
    cut = [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss"]]
    assert cut == [f"t~1{i}>😀" for i in (1, 3, 5)]


def test_repeated_turns_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, kind string"
    rows = [(1, 0, "user", "a", "z"), (1, 0, "user", "a", "z"), (1, 1, "assistant", None, "z"), (2, None, None, "b", None)]
    got = read(C.format_chats(C.events_of(spark.createDataFrame(rows, schema))))
    assert got[1] == ([("user", "a"), ("user", "a"), ("assistant", "")], "") and got[2] == ([("", "b")], "")
    assert C.format_chats(C.events_of(spark.createDataFrame([], schema))).collect() == []


def test_long_conversations(spark):
    df = spark.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
        F.concat(F.lit("<#~ some text "), "id").alias("text"),
    )
    turns, learned = read(C.format_chats(C.events_of(df)))[1]
    assert len(turns) == 20_000 and turns[19_999] == ("assistant", "<#~ some text 19999")
    assert learned == "".join(f"<#~ some text {i}" for i in range(1, 20_000, 2))
