"""Relational chat formatting: Spark expressions only.

The turns of a conversation are collected as structs and sorted; runs of one role become a
block; a block is ``HEAD role SEP text (NEXT text)* END``. Inside roles and texts a backslash
is doubled and every control string gets a backslash after its first character, so control
strings occur in the output only where the template put them, and the output can be read back.

A conversation is one record of the result: its turns meet in one row by definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
#: Strings that must not reach a tokenizer from inside a text, the template's own among them.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(s: str) -> str:
    return r"\Q" + s + r"\E"


def format_chats(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant", controls: Sequence[str] = CONTROLS) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    ``loss_spans`` are the (start, length) code point ranges of ``formatted``, from 1, that hold the
    escaped texts of ``loss_role``. Null role and null text count as empty; rows sort by turn (null
    first), then role and text, so tied turns have a fixed order and repeated rows stay repeated; a
    null conversation id is a conversation of its own. Other columns are ignored. An empty table
    gives an empty table.
    """
    if any(len(c) < 2 or "\\" in c for c in controls) or not all(any(x.startswith(c) for c in controls) for x in (HEAD, SEP, NEXT, END)):
        raise ValueError("controls have two characters or more, no backslash, and cover the template's own strings")
    clean = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    d = clean.groupBy("conv_id").agg(turns.alias("turns"))
    n = F.size("turns")
    # a block starts where the role changes
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    d = d.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(n + 1))
    blocks = F.zip_with("starts", ends, lambda a, b: F.struct(
        F.element_at("turns", a)["role"].alias("role"),
        F.transform(F.slice("turns", a, b - a), lambda t: escape(t["text"], controls)).alias("texts")))
    d = d.select("conv_id", blocks.alias("blocks"))
    head = lambda b: F.concat(F.lit(HEAD), escape(b["role"], controls), F.lit(SEP))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], NEXT), F.lit(END))), "")
    # pieces of the output: (length, under the loss mask)
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(F.struct(F.length(head(b)).cast("long").alias("len"), F.lit(False).alias("loss"))),
        F.flatten(F.transform(b["texts"], lambda t, i: F.array(
            F.struct(F.when(i == 0, 0).otherwise(len(NEXT)).cast("long").alias("len"), F.lit(False).alias("loss")),
            F.struct(F.length(t).cast("long").alias("len"), (b["role"] == loss_role).alias("loss"))))),
        F.array(F.struct(F.lit(len(END)).cast("long").alias("len"), F.lit(False).alias("loss"))))))
    d = d.select("conv_id", formatted.alias("formatted"), pieces.alias("pieces"))
    zero = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,len:bigint>>").alias("spans"))
    spans = F.aggregate("pieces", zero, lambda acc, p: F.struct(
        (acc["at"] + p["len"]).alias("at"),
        F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), p["len"].alias("len")))))
        .otherwise(acc["spans"]).alias("spans")))["spans"]
    return d.select("conv_id", "formatted", spans.alias("loss_spans"))


def parse_chats(formatted: Column) -> Column:
    """``formatted`` -> array of (role, text), one entry per turn, unescaped."""
    blocks = F.filter(F.split(formatted, _quoted(HEAD), -1), lambda b: b != "")
    def turns(b):
        parts = F.split(b, _quoted(SEP), 2)
        body = F.element_at(parts, 2)
        texts = F.split(F.substring(body, F.lit(1), F.length(body) - len(END)), _quoted(NEXT), -1)
        return F.transform(texts, lambda t: F.struct(unescape(F.element_at(parts, 1)).alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int"), s["len"].cast("int")))), "")
