"""Operator 9: chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events(conv_id, message, seq, kind, role, text). `message` orders the messages of a conversation and `seq` the
events; both may be of any type that sorts. Kinds:

    start        a message begins; its text may be there already
    delta        text is appended
    edit         the text so far is replaced
    regenerate   the text so far is dropped, and so are all later messages as far as they were logged before

The log is partitioned by conversation and message and folded in the order of `seq`: what counts of a message are the
events from its last reset (start, edit, regenerate) on, unless a message before it was regenerated later. Only the
finished messages of a conversation are brought together, as its output is one row by nature; a conversation of any
length is spread over its messages until then.

A formatted conversation is, turn after turn,

    <turn>ROLE<text>TEXT</turn>\\n

with each backslash of a role or text written as \\b and each < as \\l, so a text can hold no mark, and reading back
is exact. `loss_spans` are the places of the assistant's texts in it, in code points, end exclusive.

Cases: null text, role or kind is empty text, an empty role, a delta; an event delivered again (same conv_id, message, seq)
counts once, the largest one if they differ; a null conv_id is a conversation of its own, null messages and seqs sort
first; messages all of whose events were dropped are no turns; an empty log gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

TURN, TEXT, END = "<turn>", "<text>", "</turn>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def messages(events: DataFrame) -> DataFrame:
    """The log folded to final messages: conv_id, message, role, text."""
    log = events.select(
        "conv_id", "message", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    once = log.groupBy("conv_id", "message", "seq").agg(F.max(F.struct("kind", "role", "text")).alias("event"))
    event = F.struct(F.struct("seq").alias("at"), F.col("event.kind"), F.col("event.role"), F.col("event.text")).alias("e")
    grouped = once.select("conv_id", "message", event).groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list("e")).alias("events"),
        F.max(F.when(F.col("e.kind") != "delta", F.col("e.at"))).alias("reset"),
        F.max(F.when(F.col("e.kind") == "regenerate", F.col("e.at"))).alias("regenerated"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = grouped.withColumn("cut", F.max("regenerated").over(before))
    live = F.filter("events", lambda e: F.col("cut").isNull() | (e["at"] > F.col("cut")))
    counted = cut.withColumn("live", live).filter(F.size("live") > 0)
    # a reset before the cut is not live, but then all that is live comes behind it
    parts = F.filter("live", lambda e: F.col("reset").isNull() | (e["at"] >= F.col("reset")))
    roles = F.filter("live", lambda e: e["role"] != "")
    return counted.select(
        "conv_id", "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"),
    )


def render(folded: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans."""
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    marked = folded.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    whole = F.concat("head", "body", F.lit(END))
    order = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.char_length(whole)).over(order), F.lit(0)) + F.char_length("head")
    span = F.struct(at.alias("start"), (at + F.char_length("body")).alias("stop"))
    placed = marked.select("conv_id", "message", whole.alias("whole"), F.when(F.col("role") == LEARNED_ROLE, span).alias("span"))
    turns = F.array_sort(F.collect_list(F.struct(F.struct("message").alias("at"), "whole", "span")))
    together = placed.groupBy("conv_id").agg(turns.alias("turns"))
    return together.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["whole"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """Fold a log and render its conversations."""
    return render(messages(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned texts of formatted conversations: conv_id, turns(role, text), loss_texts, formatted."""
    pieces = F.filter(F.split("formatted", END), lambda p: p != "")
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(TURN) + 1, F.char_length(p)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(p, TEXT, -1)).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    newline = F.lit("\n")
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline)), "")
    learned = F.array_join("loss_texts", "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def log_of(conversations: DataFrame) -> DataFrame:
    """A log whose fold gives the rows of `conversations`: an assistant's text is streamed in two deltas after a draft that
    was regenerated, a system text is edited into place, any other comes whole. Rows that repeat a turn are turns of their own."""
    text = F.coalesce("text", F.lit(""))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", F.struct("turn", F.row_number().over(same).alias("nth")).alias("message"), "role", text.alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    rest = F.substring("text", half + 1, F.char_length("text"))

    def steps(*events: tuple[str, Column | str]) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("step"), F.lit(kind).alias("kind"), (F.lit(t) if isinstance(t, str) else t).alias("text")) for n, (kind, t) in enumerate(events)])

    logged = (
        F.when(F.col("role") == LEARNED_ROLE, steps(("start", ""), ("delta", "draft"), ("regenerate", ""), ("delta", F.left("text", half)), ("delta", rest)))
        .when(F.col("role") == "system", steps(("start", "default"), ("edit", F.col("text"))))
        .otherwise(steps(("start", F.col("text"))))
    )
    each = rows.select("conv_id", "message", "role", F.explode(logged).alias("event"))
    return each.select("conv_id", "message", F.struct("message", "event.step").alias("seq"), "event.kind", "role", "event.text")


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: texts made of marks."""
    said = F.lit("\\### Assistant: </turn> ok")
    roles = F.array(F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit(LEARNED_ROLE).alias("role")))
    return spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.inline(roles)).withColumn("text", said)
