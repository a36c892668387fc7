"""Chat formatting with Spark expressions: sorted turns, merged roles, reversible escapes, a loss mask.

A run of turns of one role becomes ``<|im_start|>role``, a line feed, the texts with ``<|im_sep|>`` between
them, ``<|im_end|>`` and a line feed. Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``,
so no control string can occur there; a line feed in a role becomes ``<\\nl>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"
TURNS_PER_PIECE = 64


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\nl>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\nl>"), F.lit("\n")))


def format_chats(turns: DataFrame, loss_role: str = ASSISTANT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, and ``segments``, its parts with their loss flag.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. Turns are ordered by ``turn`` (null first), ties by
    role and text, and repeated rows stay. A null text or role is empty; rows without a conversation id form
    one. Long conversations are gathered in pieces of ``TURNS_PER_PIECE`` turns first. Other columns are not
    read; an empty table gives an empty result. ``formatted`` is the segments' texts joined; a segment under
    the loss mask holds one escaped text of ``loss_role`` and nothing else.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", F.floor(F.col("turn") / TURNS_PER_PIECE).alias("piece"), F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    pieces = rows.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = pieces.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("piece", "turns"))), lambda p: p["turns"])).alias("turns"))

    def shown(turn: Column, i: Column) -> Column:
        opens = F.when(i == 0, True).otherwise(F.get("turns", i - 1)["role"] != turn["role"])
        before = F.when(opens, F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))).otherwise(SEPARATOR)
        closes = F.coalesce(F.get("turns", i + 1)["role"] != turn["role"], F.lit(True))
        after = F.when(closes, F.lit(END + "\n")).otherwise("")
        none = F.lit(False)
        part = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
        return F.array(part(before, none), part(escape(turn["text"]), turn["role"] == loss_role), part(after, none))

    segments = whole.select("conv_id", F.flatten(F.transform("turns", shown)).alias("segments"))
    return segments.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted text alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda block, i: i > 0)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(role) + 2, F.length(block) - F.length(role) - 2 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
