"""Chat formatting from event logs: fold events into messages, render them, read them back.

A log has one row per event: conv_id, message (its place in the conversation), seq (order of the
events), kind, role and text. Kinds: ``start`` opens a message with its role, ``delta`` appends,
``edit`` replaces the text so far, ``regenerate`` empties the message and drops every later
message begun before it. Rendered messages are

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings in texts and roles are escaped reversibly: a run of n backslashes between ``<``
and ``|`` becomes one of n + 1, so a text never shows ``<|``; roles escape line ends too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.session import stage

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n((?:(?!<\|).)*+)<\|im_end\|>\n", re.S)
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(plain)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turns_as_events(rows: DataFrame) -> DataFrame:
    """The log of a table of finished turns: each row starts a message and streams its text.

    Rows of a conversation are ordered by turn (missing first), rows of one turn by role and
    text; every row is a message, also one that repeats another. No window per conversation is
    needed: a message is named by its turn and a number of the row.
    """
    base = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    message = F.struct(F.col("turn"), F.col("role"), F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    return base.withColumn("message", message).select(
        "conv_id", "message",
        F.inline(F.array(
            F.struct(F.struct(F.col("turn"), F.lit(0)).alias("seq"), F.lit("start").alias("kind"),
                     F.col("role"), F.lit("").alias("text")),
            F.struct(F.struct(F.col("turn"), F.lit(1)).alias("seq"), F.lit("delta").alias("kind"),
                     F.lit(None).cast("string").alias("role"), F.col("text")))))


def fold(events: DataFrame, regenerated: bool = True) -> DataFrame:
    """Messages of a log: conv_id, message, role, text.

    Events are grouped by message, so a conversation of any length spreads over the tasks; only
    the places of its regenerations, without texts, meet in one ordered pass. Events of one
    sequence number are taken in the order start, regenerate, edit, delta, then by text.
    Missing texts count as empty. ``regenerated=False`` says that the log has no regenerations.
    """
    rank = F.create_map(*[F.lit(x) for p in (("start", 0), ("regenerate", 1), ("edit", 2), ("delta", 3))
                          for x in p])
    event = F.struct(F.col("seq"), rank[F.col("kind")].alias("rank"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("role"))
    grouped = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(event)).alias("events"))
    resets = F.transform("events", lambda e, i: F.when(e["rank"].between(1, 2), i + 1).otherwise(1))
    first = F.array_max(resets)
    kept = F.slice(F.col("events"), first, F.size("events") - first + 1)
    roles = F.filter("events", lambda e: e["role"].isNotNull())
    messages = grouped.select(
        "conv_id", "message", F.col("events")[0]["seq"].alias("begun"),
        F.coalesce(F.get(roles, F.size(roles) - 1)["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: F.when(e["rank"] == 0, "").otherwise(e["text"])), "")
        .alias("text"))
    if not regenerated:
        return messages.drop("begun")
    again = events.where(F.col("kind") == "regenerate").select("conv_id", "message", "seq")
    # the smallest regenerated message among later events, by a running minimum
    marks = messages.select("conv_id", F.col("begun").alias("at"), "message", F.lit(1).alias("own")) \
        .unionByName(again.select("conv_id", F.col("seq").alias("at"), "message", F.lit(0).alias("own")))
    later = Window.partitionBy("conv_id").orderBy(F.col("at").desc(), F.col("own")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = F.min(F.when(F.col("own") == 0, F.col("message"))).over(later)
    live = marks.withColumn("cut", cut).where("own = 1 and (cut is null or message <= cut)") \
        .select(F.col("conv_id").alias("c"), F.col("message").alias("m"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("message").eqNullSafe(F.col("m"))
    return messages.join(live, same, "left_semi").drop("begun")


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """Formatted messages with the span under the loss mask, in code points of the message.

    The text of a message whose role is ``learn`` is under the mask; others have an empty span.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    start = F.length(head)
    return messages.select(
        "conv_id", "message", F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        start.alias("loss_start"),
        F.when(F.col("role") == learn, start + F.length(body)).otherwise(start).alias("loss_end"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted messages, as they were before escaping."""
    found, at = [], 0
    while at < len(formatted):
        turn = TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no message at {at}")
        found.append((unescape_role(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read back from its formatted messages.

    A digest over a whole conversation is sequential, so its messages pass through one task in
    order; the task holds one batch and two running digests, however long the conversation is.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        open_, key = None, None
        for batch in batches:
            for conv, text, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ is None or conv != key:
                    if open_ is not None:
                        done.append(close(key, open_))
                    key, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, plain in parse(text):
                    open_[0] += 1
                    open_[1].update(f"{role}\n{plain}\n".encode())
                under = unescape(text[start:stop])
                open_[2] += len(under)
                open_[3].update(under.encode())
                open_[4] += len(text)
            if len(done) >= 5_000:
                yield table(done)
                done = []
        if open_ is not None:
            done.append(close(key, open_))
        if done:
            yield table(done)

    def close(key, state):
        turns, all_, chars, loss, size = state
        return key, turns, all_.hexdigest(), chars, loss.hexdigest(), size

    def table(rows):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return rendered.repartition("conv_id").sortWithinPartitions("conv_id", "message") \
        .select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(task, DIGESTS)


def format_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Written and reread messages of a table of turns (conv_id, turn, role, text)."""
    return stage(render(fold(turns_as_events(rows), regenerated=False)), "chat")
