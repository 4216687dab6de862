"""Chat transcripts rebuilt from event logs, rendered with turn marks and a loss mask.

A log has rows (conv_id, seq, message, kind, role, text). `message` orders the messages of a conversation; events
are folded in the order of `seq`:

* `message` starts a message (again) with a role and a first text,
* `delta` appends its text,
* `edit` replaces the text so far,
* `regenerate` discards the text so far; later messages that had been started before it are dropped.

A message's text is the concatenation of its texts from the last event that resets it. Messages are folded in a
group of their own first; only final messages meet in their conversation, where one string is what is asked for.

The template is `<|im_start|>` role newline text `<|im_end|>` newline. Control strings inside texts are escaped:
a `<` and a `|` with any number of backslashes between them get one backslash more, so no `<|` is left and one
backslash less restores the text. In roles `%`, newline and `<` become `%25`, `%0A` and `%3C`.

Results by case: null text is empty, null role is an empty role, a message that only has deltas has the role of
its first event with one; events with equal `seq` are ordered by kind and text, and an event that occurs twice
counts twice; a null conversation is one of its own; an empty log gives an empty frame; unknown kinds are ignored,
but their message exists; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values of the template
START = "<|im_start|>"
END = "<|im_end|>\n"
LEARNED_ROLE = "assistant"
RESETS = ["message", "edit", "regenerate"]


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log."""
    e = events.select(
        "conv_id", "message", F.col("seq").cast("bigint").alias("seq"), F.coalesce(F.col("kind").cast("string"), F.lit("")).alias("kind"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    resets = F.col("kind").isin(RESETS)
    folded = e.groupBy("conv_id", "message").agg(
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.max(F.when(F.col("kind") == "message", F.col("seq"))).alias("started"),
        F.min("seq").alias("first"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.max(F.when(F.col("kind") == "message", F.struct("seq", "role")))["role"].alias("start_role"),
        F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))["role"].alias("any_role"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", "text"))).alias("parts"),
    )
    live = F.filter("parts", lambda p: p["kind"].isin([*RESETS, "delta"]) & (F.col("reset").isNull() | (p["seq"] >= F.col("reset"))))
    text = F.array_join(F.transform(live, lambda p: F.when(p["kind"] == "regenerate", F.lit("")).otherwise(p["text"])), "")
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    dropped = F.max("regenerated").over(earlier) > F.coalesce("started", "first")
    done = folded.select("conv_id", "message", F.coalesce("start_role", "any_role", F.lit("")).alias("role"), text.alias("text"), dropped.alias("dropped"))
    return done.where(~F.coalesce(F.col("dropped"), F.lit(False))).drop("dropped")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): the transcript, and the spans (start, end in code points) that carry loss."""
    turn = F.struct("message", escape_role(F.col("role")).alias("role"), escape(F.col("text")).alias("text"), (F.col("role") == LEARNED_ROLE).alias("learn"))
    head = len(START) + 1
    grouped = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.char_length(t["role"]) + head
        end = begin + F.char_length(t["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(t["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>").alias("spans"))
    return grouped.select("conv_id", whole.alias("formatted"), F.aggregate("turns", empty, step, lambda acc: acc["spans"]).alias("mask"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a transcript, unescaped."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.char_length(role) + 2, F.char_length(piece) - F.char_length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def conversation_log(rows: DataFrame) -> DataFrame:
    """The log of finished turns (conv_id, turn, role, text): a start and two streamed halves for each.

    Turns that share a number are separate messages, ordered by role and text.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    n = F.coalesce(F.floor(F.char_length("text") / 2), F.lit(0)).cast("int")
    event = lambda i, kind, role, text: F.struct(F.lit(i).alias("i"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    nothing = F.lit(None).cast("string")
    parts = F.array(
        event(0, "message", F.col("role"), nothing),
        event(1, "delta", nothing, F.substring(F.col("text"), F.lit(1), n)),
        event(2, "delta", nothing, F.substring(F.col("text"), n + 1, F.char_length("text"))),
    )
    placed = rows.withColumn("message", place)  # apart from the explode, which Spark would put before the window
    exploded = placed.select("conv_id", "message", F.explode(parts).alias("e"))
    return exploded.select("conv_id", (F.col("message") * 3 + F.col("e.i")).alias("seq"), "message", "e.kind", "e.role", "e.text")
