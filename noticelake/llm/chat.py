"""Chat formatting with prefix-target expansion.

A turn is written as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line
feed. Every assistant turn becomes an example of its own: all turns before it are context and
its text alone is trainable. Turns after the last assistant turn would be in no example; a
conversation that ends otherwise gets one more example, of all its turns, with nothing
trainable.

Within texts and roles one backslash goes between ``<`` and ``|``, also where backslashes
stand there already, so no text holds a control string and the step can be undone. Line feeds
in roles are written ``<|nl|>``.

Turns are in order of their number, null first, then role and text. A null text or role is
empty. Repeated rows are turns of their own. Rows with a null conversation are one
conversation. Only the four columns are read. A conversation is one value, as long as its text,
and its examples together grow with the square of its turns, as the expansion asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, FEED = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(FEED)), F.lit("\n"))


def expand(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """``conv_id, example, formatted, loss_start, loss_chars``; offsets are in code points."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = (
        conversations.select(
            F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t")
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    written = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == trained_role).alias("trained"), _head(t["role"]).alias("head"), escape(t["text"]).alias("body")
        ),
    )
    whole = F.transform("w", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n")))
    last = F.size("w") - 1
    marked = F.transform("w", lambda t, i: F.when(t["trained"] | (i == last), i))
    return (
        turns.select("conv_id", written.alias("w"))
        .select("conv_id", "w", whole.alias("whole"), F.explode(F.array_compact(marked)).alias("example"))
        .withColumn("turn", F.get("w", F.col("example")))
        .withColumn("context", F.array_join(F.slice("whole", F.lit(1), F.col("example")), ""))
        .select(
            "conv_id",
            "example",
            F.concat("context", "turn.head", "turn.body", F.lit(END + "\n")).alias("formatted"),
            (F.length("context") + F.length("turn.head")).alias("loss_start"),
            F.when(F.col("turn.trained"), F.length("turn.body")).otherwise(0).alias("loss_chars"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: ``array<struct<role, text>>``."""

    def turn(part: Column) -> Column:
        feed = F.locate("\n", part)
        body = F.substring(part, feed + 1, F.length(part) - feed - len(END) - 1)
        role = F.replace(F.substring(part, F.lit(1), feed - 1), F.lit(FEED), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    parts = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The trainable text as it was before formatting."""
    return unescape(F.substring(formatted, loss_start + 1, loss_chars))
