"""Chat formatting with Spark expressions only.

Turns are collected per conversation as structs and sorted, adjacent turns of
one role are merged to a block, and blocks are concatenated to one text:

    <|start|>role<|text|>first text<|turn|>next text of the same role<|end|>\\n

The template's markers and common control strings inside roles and texts are
escaped: a backslash is doubled, and a single one is put behind the first
character of a control string, so that none is left; ``unescape`` undoes both.
``segments`` are the same text in pieces, each with its loss flag: exactly the
texts of ``loss_roles`` are under the loss mask. ``read_turns`` parses the
formatted text back.

A conversation's text is one value, so its turns do meet in one task; nothing
else does, and all steps are linear in its length.

Defined cases: null text and null role count as empty; turns of one number are
ordered by role and text, null turn numbers last; repeated rows are turns of
their own; rows with null conversation id form one conversation with that id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import col

START, TEXT, TURN, END = "<|start|>", "<|text|>", "<|turn|>", "<|end|>\n"
# fixed values: control strings of common chat templates
CONTROLS = ("<|start|>", "<|text|>", "<|turn|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
            "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    starts = "(?s)(?=" + "|".join(f"\\Q{c}\\E" for c in CONTROLS) + ")(.)"
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), starts, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _blocks(turns: Column) -> Column:
    """Sorted turns merged to (role, texts) blocks."""
    def opens(i: Column) -> Column:
        return (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])

    at = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), opens)
    ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(turns)))
    return F.zip_with(at, ends, lambda a, b: F.struct(
        F.get(turns, a)["role"].alias("role"),
        F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts")))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments(text, loss)."""
    own = turns.select(
        col(conv_col).alias("conv_id"), col(turn_col).isNull().alias("last"), col(turn_col).alias("turn"),
        escape(F.coalesce(col(role_col), F.lit(""))).alias("role"),
        escape(F.coalesce(col(text_col), F.lit(""))).alias("text"))
    chats = (own.groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("last", "turn", "role", "text"))).alias("turns"))
             .select("conv_id", _blocks(F.col("turns")).alias("blocks")))
    loss = [escape(F.lit(r)) for r in loss_roles]

    def segment(text: Column, flag: Column) -> Column:
        return F.struct(text.alias("text"), flag.alias("loss"))

    def of_block(b: Column) -> Column:
        texts = F.flatten(F.transform(b["texts"], lambda t, i: F.array(
            segment(F.when(i == 0, F.concat(F.lit(START), b["role"], F.lit(TEXT))).otherwise(F.lit(TURN)), F.lit(False)),
            segment(t, b["role"].isin(*loss)))))
        return F.concat(texts, F.array(segment(F.lit(END), F.lit(False))))

    return (chats.select("conv_id", F.flatten(F.transform("blocks", of_block)).alias("segments"))
            .select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text, unescaped."""
    def of_block(block: Column) -> Column:
        role = F.substring_index(block, TEXT, 1)
        body = F.substr(block, F.length(role) + len(TEXT) + 1,
                        F.length(block) - F.length(role) - (len(TEXT) + len(END)))
        return F.transform(F.split(body, re.escape(TURN)),
                           lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, re.escape(START))
    return F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), of_block))


def loss_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
