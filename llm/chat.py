"""Chat formatting in Spark expressions alone.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged into blocks with array functions,
and blocks are joined to one string:

    <|start|>role<|text|>first text<|next|>second text of the same role<|end|>\\n

Inside roles and texts a backslash is doubled and every control string gets one after its first character, which no control string
contains, so texts can't forge marks and are read back exactly. The loss mask is a list of spans (code points) over the assistant's
texts alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from llm.exprs import let, positions

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>\n"
#: Broken up in texts: the beginning of every mark, and marks of other templates that a model may know.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    if any("\\" in c or len(c) < 2 for c in controls):
        raise ValueError("a control string has two characters or more and no backslash")
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), controls, doubled)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def collect_turns(turns: DataFrame) -> DataFrame:
    """conv_id and turns: array of (turn, role, text) sorted by turn, then role and text; nulls first, null role and text empty.

    A row is a conversation, so one conversation is held by one task, as any formatter's output row must be.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("bigint"), F.struct(F.col("turn").cast("bigint"), empty("role"), empty("text")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _blocks(turns: Column) -> Column:
    """Runs of one role: array of (role, texts)."""
    role = lambda i: F.get(turns, i)["role"]
    starts = F.filter(positions(turns), lambda i: (i == 0) | (role(i) != role(i - 1)))

    def run(starts: Column) -> Column:
        length = lambda at, k: F.coalesce(F.get(starts, k + 1), F.size(turns)) - at
        texts = lambda at, k: F.transform(F.slice(turns, at + 1, length(at, k)), lambda t: t["text"])
        return F.transform(starts, lambda at, k: F.struct(role(at).alias("role"), texts(at, k).alias("texts")))

    return let(starts, run)


def _parts(block: Column, learned: str, controls: Sequence[str]) -> Column:
    """The strings of a block in order, with loss true on texts of the learned role."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    mark = lambda text: part(text, F.lit(False))
    texts = F.transform(block["texts"], lambda t, i: F.array(
        mark(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT))), part(escape(t, controls), block["role"] == learned)))
    head = mark(F.concat(F.lit(START), escape(block["role"], controls), F.lit(TEXT)))
    return F.concat(F.array(head), F.flatten(texts), F.array(mark(F.lit(END))))


def _spans(parts: Column) -> Column:
    """(at, length) in code points of the parts under the loss mask."""
    kind = "struct<at:int,spans:array<struct<at:int,length:int>>>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,length:int>>").alias("spans")).cast(kind)

    def add(acc: Column, part: Column) -> Column:
        length = F.char_length(part["text"])
        more = F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("at"), length.alias("length"))))
        return F.struct((acc["at"] + length).alias("at"), F.when(part["loss"], more).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(parts, none, add, lambda acc: acc["spans"])


def format_conversations(turns: DataFrame, *, learned: str = "assistant", controls: Sequence[str] = CONTROLS) -> DataFrame:
    """conv_id, formatted, loss_spans. Extra columns are ignored; equal rows are turns of their own; no rows give no rows."""
    parts = let(_blocks(F.col("turns")), lambda b: F.flatten(F.transform(b, lambda x: _parts(x, learned, controls))))
    made = let(parts, lambda p: F.struct(F.array_join(F.transform(p, lambda x: x["text"]), "").alias("formatted"), _spans(p).alias("loss_spans")))
    return collect_turns(turns).select("conv_id", made.alias("m")).select("conv_id", "m.formatted", "m.loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array of (role, text), merged turns apart again."""
    quoted = lambda mark: f"\\Q{mark}\\E"
    ended = F.split(formatted, quoted(END), -1)
    blocks = F.slice(ended, 1, F.size(ended) - 1)

    def turns(block: Column) -> Column:
        halves = F.split(F.substring(block, len(START) + 1, 1 << 30), quoted(TEXT), 2)
        texts = F.split(F.get(halves, F.lit(1)), quoted(NEXT), -1)
        return F.transform(texts, lambda t: F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order and unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["at"] + 1, s["length"]))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted strings and spans."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    told = let(read_turns(F.col("formatted")), lambda t: F.struct(
        F.size(t).cast("bigint").alias("n"), F.sha2(F.array_join(F.transform(t, line), "").cast("binary"), 256).alias("sha")))
    loss = let(read_loss_text(F.col("formatted"), F.col("loss_spans")), lambda t: F.struct(
        F.char_length(t).cast("bigint").alias("n"), F.sha2(t.cast("binary"), 256).alias("sha")))
    rows = formatted.select("conv_id", told.alias("t"), loss.alias("l"), F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    return rows.selectExpr("conv_id", "t.n as n_turns", "t.sha as turns_sha256", "l.n as loss_chars", "l.sha as loss_sha256", "formatted_chars")
