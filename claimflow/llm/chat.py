"""Chat formatting (native): events of conversations folded into messages, then rendered.

A log has rows (conv_id, seq, message, kind, role, text).  Kinds:

``message``     opens a message with a role and its text (null: empty)
``delta``       adds text to the message, as streamed
``edit``        replaces the text of the message
``regenerate``  throws the text away; the deltas after it build it anew

Rendered, a turn is ``### <role>: <text></turn>`` and a line end.  In roles and texts
``~``, ``<``, ``#`` and, in roles, ``:`` are written as ``~0``, ``~1``, ``~2``, ``~3``, so
neither mark can occur inside, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
COLON = ": "
LEARNED = "assistant"  # the role under the loss mask
_ESCAPES = [("~", "~0"), ("<", "~1"), ("#", "~2"), (":", "~3")]  # in this order; undone in the opposite one


def escape(text: Column, role: bool = False) -> Column:
    for plain, mark in _ESCAPES if role else _ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, mark in reversed(_ESCAPES if role else _ESCAPES[:3]):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def events_of(turns: DataFrame) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): one opening event each."""
    # Rows that repeat a turn stay messages of their own, told apart by number.
    twin = F.row_number().over(_window(turns))
    return turns.select(
        "conv_id",
        F.struct("turn", twin.alias("twin")).alias("seq"),
        F.struct("turn", twin.alias("twin")).alias("message"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


def _window(turns: DataFrame):
    from pyspark.sql import Window

    return Window.partitionBy("conv_id", "turn").orderBy("role", "text")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text) of the final messages.

    Events are grouped by message, not by conversation, so a conversation with a third
    of all events is spread.  The last event that sets a text (message, edit,
    regenerate) is the base; deltas after it are added in order of seq.  seq is the
    place of the first event.  Equal seq: deltas follow what sets the text, then by
    text.  The role is that of the last event that names one.  Messages whose events
    never set a text start empty.  Events of unknown kinds are an error of the log and
    are passed over.
    """
    sets = F.col("kind").isin("message", "edit", "regenerate")
    order = F.struct("seq", (~sets).cast("int").alias("late"))
    body = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    known = events.filter(F.col("kind").isin("message", "edit", "regenerate", "delta"))
    return (
        known.select("conv_id", "message", "seq", "role", "kind", order.alias("at"), body.alias("body"))
        .groupBy("conv_id", "message")
        .agg(
            F.min("seq").alias("seq"),
            F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).alias("role"),
            F.max(F.when(F.col("kind") != "delta", F.struct("at", "body"))).alias("base"),
            F.sort_array(F.collect_list(F.when(F.col("kind") == "delta", F.struct("at", "body")))).alias("deltas"),
        )
        .select(
            "conv_id",
            "seq",
            F.coalesce("role", F.lit("")).alias("role"),
            F.concat(
                F.coalesce("base.body", F.lit("")),
                F.array_join(
                    F.transform(
                        F.filter("deltas", lambda d: F.col("base").isNull() | (d["at"] > F.col("base.at"))), lambda d: d["body"]
                    ),
                    "",
                ),
            ).alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss) per conversation.

    ``loss`` lists the texts to learn from, those of the assistant, as (turn, skip,
    start, length) in characters: ``start`` counts from the head of ``formatted``,
    ``skip`` from the head of the turn, so that a reader who has cut the turns apart
    need not count from the start each time.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(COLON))
    body = escape(F.col("text"))
    turns = messages.select(
        "conv_id", "seq", F.length(head).alias("skip"), F.length(body).alias("length"), (F.col("role") == LEARNED).alias("learned"),
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
    ).withColumns(
        {
            "turn": F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY seq) - 1"),
            "before": F.expr(
                "sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
                " - length(piece)"
            ),
        }
    )
    span = F.struct("turn", "skip", (F.col("before") + F.col("skip")).alias("start"), F.col("length").cast("long").alias("length"))
    return turns.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "piece"))), lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("learned"), span))).alias("loss"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """``render`` of ``fold``: one row per conversation of the log.

    Nulls: null texts are empty, a message without any role has the empty role; a null
    conv_id is a conversation of its own.  Repeated events act as often as they come.
    Extra columns of the log are left out.  A log without rows gives none.
    """
    return render(fold(events))


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, not once per use inside a lambda."""
    return F.transform(F.array(value), then)[0]


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, learned, formatted) from what ``render`` wrote.

    ``turns`` lists (role, text); ``learned`` is all text under the loss mask, each
    span once, in order, nothing between.
    """
    pieces = F.split(F.col("formatted"), CLOSE)

    def turn(p: Column) -> Column:
        colon = F.locate(COLON, p)
        return F.struct(
            unescape(F.substring(p, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1), role=True).alias("role"),
            unescape(F.substring(p, colon + len(COLON), F.length(p))).alias("text"),
        )

    return chats.select(
        "conv_id",
        "formatted",
        F.transform(F.slice(pieces, F.lit(1), F.col("n_turns").cast("int")), turn).alias("turns"),
        unescape(
            _once(
                pieces,
                lambda p: F.array_join(
                    F.transform("loss", lambda s: F.substring(F.get(p, s["turn"]), s["skip"] + 1, s["length"].cast("int"))), ""
                ),
            )
        ).alias("learned"),
    )
