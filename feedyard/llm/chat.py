"""Chat formatting: conversations to training text, in Spark expressions only.

Turns are collected per conversation as structs and sorted; adjacent turns of
one role are merged into one block by array aggregation, and the blocks are
concatenated::

    <|im_start|>role\\ntext<|im_next|>text<|im_end|>\\n

``<|im_next|>`` parts the turns merged into one block, so the turns can be
read back exactly. Control strings inside texts and roles (these marks, any
other ``<|name|>``, ``<s>``, ``[INST]``, ``<<SYS>>`` and their closing forms)
get one backslash after their first character; those that already have
backslashes there get one more, which makes the escape reversible.

Defined results: null text and null role count as empty; turns order by
(turn, role, text) with null turns first, so ties and repeated rows keep a
stable order and stay; rows without conversation id form one conversation
with a null id; an empty table gives an empty result; other columns are not
read. One conversation is one output row, so it must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import let

BEGIN, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>"

# what follows the first character of a control string
_ANGLE = r"(?:\|\w+\|>|/?s>|</?SYS>>)"
_SQUARE = r"/?INST\]"
_PLAIN = rf"(?<=<)(\\*{_ANGLE})|(?<=\[)(\\*{_SQUARE})"
_ESCAPED = rf"(?<=<)\\(\\*{_ANGLE})|(?<=\[)\\(\\*{_SQUARE})"


def escape(text: Column) -> Column:
    """No control string is left in the result; ``unescape`` undoes it."""
    return F.regexp_replace(text, _PLAIN, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def _escape_role(role: Column) -> Column:
    # a role ends at the first newline, so newlines are written as \n and
    # backslashes as \-
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\-")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\-"), F.lit("\\")))


def merged_blocks(turns: Column) -> Column:
    """Sorted turn structs -> array<struct<role, texts>>, one per run of a role."""
    def blocks(sorted_turns: Column) -> Column:
        n = F.size(sorted_turns)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(sorted_turns, i)["role"] != F.get(sorted_turns, i - 1)["role"]),
        )
        return let(starts, lambda s: F.transform(s, lambda first, k: F.struct(
            F.get(sorted_turns, first)["role"].alias("role"),
            F.transform(
                F.slice(sorted_turns, first + 1, F.coalesce(F.get(s, k + 1), n) - first),
                lambda t: t["text"],
            ).alias("texts"),
        )))
    return let(turns, blocks)


def _segments(blocks: Column, loss_role: str) -> Column:
    def seg(text, loss):
        return F.struct(text.alias("text"), loss.alias("in_loss"))

    no = F.lit(False)

    def of_block(b):
        loss = b["role"] == loss_role
        body = F.flatten(F.transform(b["texts"], lambda t, k: F.when(
            k == 0, F.array(seg(escape(t), loss))
        ).otherwise(F.array(seg(F.lit(NEXT), no), seg(escape(t), loss)))))
        head = F.concat(F.lit(BEGIN), _escape_role(b["role"]), F.lit("\n"))
        return F.concat(F.array(seg(head, no)), body, F.array(seg(F.lit(END + "\n"), no)))

    return F.flatten(F.transform(blocks, of_block))


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, n_blocks, formatted, segments.

    ``segments`` are the consecutive pieces of ``formatted`` with ``in_loss``
    set on the texts of ``loss_role``: the loss mask in run-length form.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    formed = collected.select("conv_id", let(merged_blocks(F.col("turns")), lambda b: F.struct(
        F.size(b).alias("n_blocks"), _segments(b, loss_role).alias("segments"),
    )).alias("f"))
    return formed.select(
        "conv_id",
        F.col("f.n_blocks").alias("n_blocks"),
        F.array_join(F.col("f.segments.text"), "").alias("formatted"),
        F.col("f.segments").alias("segments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns written into a formatted text: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def of_block(b):
        head = F.substring_index(b, "\n", 1)
        body = F.substr(b, F.char_length(head) + 2)
        return let(_unescape_role(F.substr(head, F.lit(len(BEGIN) + 1))), lambda role: F.transform(
            F.split(body, r"<\|im_next\|>", -1),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        ))

    return F.flatten(F.transform(blocks, of_block))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(
        F.filter(segments, lambda s: s["in_loss"]), lambda s: unescape(s["text"])
    ), "")
