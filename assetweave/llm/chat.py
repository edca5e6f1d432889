"""Chat formatting with built-in expressions only.

A conversation's turns are collected as structs, sorted, and adjacent turns of the same role merged into one block:

    <s>role[TEXT]text of the turn[NEXT]text of a turn merged with it</s>

Control strings inside roles and texts (those above and common ones of other templates) get one backslash more after their
bracket than they have, so texts cannot end a turn, and reading takes that backslash away again.

Long conversations are taken in chunks of `CHUNK` turn numbers: a chunk is sorted and merged where it lies, and the
conversation joins the blocks of its chunks, merging once more at their borders. Repeated rows are counted before anything is
collected. A conversation's formatted text is one value, so it has to fit into a row.

Defined results: null texts and roles are empty; turns are ordered by (turn, role, text), null turns first, repeated rows
follow each other; a null conv_id is a conversation of its own; an empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = 128
BEGIN, TEXT, NEXT, END = "<s>", "[TEXT]", "[NEXT]", "</s>"
# What may follow a bracket in a control string.
_RESTS = r"/?s>|/?INST\]|TEXT\]|NEXT\]|/?ROLE\]|</?SYS>>|\|"
_PLAIN, _ESCAPED = rf"([<\[])(\\*)({_RESTS})", rf"([<\[])\\(\\*)({_RESTS})"
BLOCK = "array<struct<role:string,texts:array<string>>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def merged(blocks: Column) -> Column:
    """Adjacent blocks of the same role as one block, with the texts of all."""
    first = F.filter(
        F.sequence(F.lit(0), F.size(blocks) - 1),
        lambda i: (i == 0) | (F.get(blocks, i)["role"] != F.get(blocks, i - 1)["role"]),
    )
    bounds = F.concat(first, F.array(F.size(blocks)))
    return F.transform(first, lambda i, k: F.struct(
        F.get(blocks, i)["role"].alias("role"),
        F.flatten(F.transform(F.slice(blocks, i + 1, F.get(bounds, k + 1) - i), lambda b: b["texts"])).alias("texts"),
    ))


def collected(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, blocks): the merged blocks of each conversation, in order."""
    rows = turns.select(
        turns["conv_id"], turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("text"),
    )
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("times"))
    chunks = once.groupBy("conv_id", F.floor(F.col("turn") / chunk).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "times"))).alias("turns")
    )
    blocks = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), F.array_repeat(t["text"], t["times"]).alias("texts")))
    chunks = chunks.select("conv_id", "chunk", blocks.alias("blocks")).select("conv_id", "chunk", merged(F.col("blocks")).alias("blocks"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "blocks"))).alias("chunks"))
    flat = whole.select("conv_id", F.flatten(F.transform("chunks", lambda c: c["blocks"])).alias("blocks"))
    return flat.select("conv_id", merged(F.col("blocks")).alias("blocks"))


def format_conversations(turns: DataFrame, chunk: int = CHUNK, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, segments): segments are the parts of the text with `loss`, true for texts of the role
    `learn` only; joined they are the text."""

    def part(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("part"), loss.alias("loss"))

    def block(b: Column) -> Column:
        head = part(F.concat(F.lit(BEGIN), escape(b["role"]), F.lit(TEXT)), F.lit(False))
        texts = F.flatten(F.transform(b["texts"], lambda t, i: F.array(
            part(F.when(i == 0, "").otherwise(NEXT), F.lit(False)), part(escape(t), b["role"] == learn)
        )))
        return F.concat(F.array(head), F.filter(texts, lambda s: (s["part"] != "") | s["loss"]), F.array(part(F.lit(END), F.lit(False))))

    blocks = collected(turns, chunk)
    out = blocks.select("conv_id", F.flatten(F.transform("blocks", block)).alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["part"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted text was made of."""
    pieces = F.split(formatted, END, -1)
    blocks = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    heads = F.transform(blocks, lambda b: F.split(F.substring(b, F.lit(len(BEGIN) + 1), F.length(b)), r"\[TEXT\]", 2))
    return F.flatten(F.transform(heads, lambda h: F.transform(
        F.split(h[1], r"\[NEXT\]", -1), lambda t: F.struct(unescape(h[0]).alias("role"), unescape(t).alias("text"))
    )))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["part"])), "")
