"""Chat formatting with Spark expressions only.

Turns of a conversation are sorted, neighbours of one role are merged into a block, and
blocks are joined into one text:

    <|user|>first text<|+|>second text<|end|><|assistant|>reply<|end|>

Inside texts and roles ``&``, ``<`` and ``[`` are written as ``&amp;``, ``&lt;`` and
``&lb;`` (in roles also ``|`` as ``&vb;``), so no control string of this or of other
common templates (``</s>``, ``[INST]``, ``<|end|>``) survives inside a text, and reading back
is exact.

Defined cases: null text and null role are empty; turns are ordered by turn (null
first), then role, then text; repeated rows stay; an empty table gives an empty table; a
conversation with a null id is one conversation. Columns besides the named ones are
ignored. One conversation is one row of the result, so it must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatweave.llm.columns import let, running_sums

END, NEXT = "<|end|>", "<|+|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
ROLE_ESCAPES = (*ESCAPES, ("|", "&vb;"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, safe in pairs:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, pairs=ROLE_ESCAPES) -> Column:
    for plain, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _blocks(turns: Column) -> Column:
    """Neighbouring turns of one role as (role, texts)."""
    def merge(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (
            F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
        return let(starts, lambda s: F.transform(s, lambda at, i: F.struct(
            F.get(t, at)["role"].alias("role"),
            F.transform(F.slice(t, at + 1, F.coalesce(F.get(s, i + 1), F.size(t)) - at),
                        lambda x: x["text"]).alias("texts"))))

    return let(turns, merge)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", trained: str = "assistant") -> DataFrame:
    """Per conversation: ``formatted`` and ``loss_spans``, the code point ranges (end
    exclusive) of the texts of role ``trained``."""
    own = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("turn"))
    sorted_turns = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    blocks = sorted_turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))

    def pieces(b: Column) -> Column:
        """Alternately marks and texts, each with its use in the loss."""
        loss = b["role"] == trained
        opening = F.concat(F.lit("<|"), escape(b["role"], ROLE_ESCAPES), F.lit("|>"))
        body = F.transform(b["texts"], lambda x, i: F.array(
            F.struct(F.when(i == 0, opening).otherwise(F.lit(NEXT)).alias("s"), F.lit(False).alias("loss")),
            F.struct(escape(x).alias("s"), loss.alias("loss"))))
        return F.array_append(F.flatten(body), F.struct(F.lit(END).alias("s"), F.lit(False).alias("loss")))

    split = blocks.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("p"))
    ends = split.select("conv_id", "p", running_sums(F.transform("p", lambda x: F.length(x["s"]))).alias("ends"))
    spans = F.filter(F.zip_with("p", "ends", lambda x, e: F.struct(
        (e - F.length(x["s"])).alias("start"), e.alias("end"), x["loss"].alias("loss"))), lambda x: x["loss"])
    return ends.select(
        "conv_id", F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"),
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were given."""
    def turns(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, r"^<\|([^|]*)\|>", 1))
        body = F.regexp_replace(block, r"^<\|[^|]*\|>", "")
        return let(role, lambda r: F.transform(F.split(body, r"<\|\+\|>", -1), lambda x: F.struct(
            r.alias("role"), unescape(x, ESCAPES).alias("text"))))

    found = F.split(formatted, r"<\|end\|>", -1)
    return let(found, lambda b: F.flatten(F.transform(F.slice(b, 1, F.size(b) - 1), turns)))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), ESCAPES))
