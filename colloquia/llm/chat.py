"""Chat formatting by event-sourced reconstruction (native).

A log of events per conversation (message starts, streamed deltas, edits, regenerations) is
folded into final messages, which a template renders with a loss mask over assistant texts.
Windows and one aggregation share a single shuffle by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

OPEN, CLOSE = "### ", "</turn>\n"

#: Code points of a streamed part.
CHUNK = 4096

START, DELTA, EDIT, REGENERATE = "start", "delta", "edit", "regenerate"


def escape_text(text: Column) -> Column:
    r"""Reversible: ``\`` doubles, and a ``\`` splits each ``</turn>`` and each ``### ``."""
    return F.regexp_replace(text, r"\\|(?<=<)/(?=turn>)|(?<=#)#(?=# )", r"\\$0")


def escape_role(role: Column) -> Column:
    """Like escape_text, and without ``: ``, which ends the role in a header."""
    return F.regexp_replace(role, r"\\|(?<=<)/(?=turn>)|(?<=#)#(?=# )|(?<=:) ", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def log_of_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A table of whole turns as a log: each turn starts empty and is streamed in deltas of ``chunk`` code points.

    Null role or text is empty. Rows with the same turn number are put in order of role, then
    text; repeated rows stay.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long")
    start = F.array(F.struct(F.lit(START).alias("kind"), F.lit("").alias("text")))
    parts = F.when(F.length("text") > 0, F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))).otherwise(F.array().cast("array<int>"))
    deltas = F.transform(parts, lambda i: F.struct(F.lit(DELTA).alias("kind"), F.substr("text", i * chunk + 1, F.lit(chunk)).alias("text")))
    numbered = rows.withColumn("message", number)
    events = numbered.select("conv_id", "role", "message", F.posexplode(F.concat(start, deltas)).alias("at", "event"))
    return events.select("conv_id", (F.shiftleft("message", 32) + F.col("at")).alias("seq"), "event.kind", "message", "role", "event.text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, seq, kind, message, role, text).

    start opens a message, delta appends to it, edit replaces its whole text, regenerate drops
    the message's earlier content and all messages of a higher number opened before it.
    Events are taken by seq, ties by kind and text; a message without start takes the first
    non-null role of its events; null text appends nothing.
    """
    order = [F.col("seq"), F.col("kind"), F.col("text")]
    backwards = Window.partitionBy("conv_id").orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    dropped_from = F.min(F.when(F.col("kind") == REGENERATE, F.col("message"))).over(backwards)
    alive = events.withColumn("_from", dropped_from).where(F.col("_from").isNull() | (F.col("_from") > F.col("message"))).drop("_from")
    later = Window.partitionBy("conv_id", "message").orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    edited = F.coalesce(F.max(F.when(F.col("kind") == EDIT, True)).over(later), F.lit(False))
    parts = alive.select("conv_id", "message", "seq", "kind", "role", F.when(edited, F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"))
    folded = parts.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(F.struct("seq", "kind", "text"))).alias("parts"),
        F.min(F.when(F.col("role").isNotNull(), F.struct(F.col("seq"), F.col("role").alias("role")))).alias("first"),
    )
    return folded.select(
        "conv_id",
        "message",
        F.coalesce("first.role", F.lit("")).alias("role"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render_chat(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, mask.

    Each message becomes one line ``### role: text</turn>``. ``mask`` has for each turn its
    start and the start and end of its text in code points, and whether the loss covers it.
    Messages are rendered before they are gathered; the gathered row is the conversation itself.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(": "))
    turn = messages.select("conv_id", "message", "role", head.alias("head"), escape_text(F.col("text")).alias("body"))
    turn = turn.withColumn("line", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("at", F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)))
    text_at = F.col("at") + F.length("head")
    gathered = turn.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(
            "message", "line", F.col("at").alias("turn_start"), text_at.alias("text_start"),
            (text_at + F.length("body")).alias("text_end"), (F.col("role") == loss_role).alias("loss"),
        ))).alias("turns")
    )
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
        F.transform("turns", lambda t: t.dropFields("message", "line")).alias("mask"),
    )


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text, line>> read back from rendered text."""

    def turn(line: Column) -> Column:
        body = F.substr(line, F.lit(len(OPEN) + 1))
        return let(F.instr(body, ": "), lambda colon: F.struct(
            unescape(F.substr(body, F.lit(1), colon - 1)).alias("role"), unescape(F.substr(body, colon + 2)).alias("text"), line.alias("line")
        ))

    lines = F.split(formatted, CLOSE, -1)
    return let(lines, lambda x: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), turn))


def masked_texts(turns: Column, mask: Column) -> Column:
    """Texts under the loss mask, unescaped; each is cut from its own turn, so long chats cost no more per turn."""

    def cut(turn: Column, i: Column) -> Column:
        span = F.get(mask, i)
        return F.when(span["loss"], unescape(F.substr(turn["line"], (span["text_start"] - span["turn_start"] + 1).cast("int"), (span["text_end"] - span["text_start"]).cast("int"))))

    return F.array_compact(F.transform(turns, cut))
