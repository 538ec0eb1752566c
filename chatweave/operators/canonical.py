"""From source rows to canonical ``messages`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chatweave.functions.messages import instruction_pair, message, system_prefix
from chatweave.functions.numbers import whole_div
from chatweave.schemas import MESSAGES

# Accepted column names, in order of preference.
PROMPT_NAMES = ("input", "instruction")
ANSWER_NAMES = ("output", "response")


def column_or(df: DataFrame, names: Sequence[str], default: str = "", null_fallback: bool = False) -> Column:
    """The first of ``names`` that ``df`` has, else the default.

    The fall-back is on a missing column, not on a null value: an existing column
    keeps its nulls. ``null_fallback`` asks for the other rule.
    """
    present = [F.col(n) for n in names if n in df.columns]
    if null_fallback:
        return F.coalesce(*present, F.lit(default))
    return present[0] if present else F.lit(default)


def canonical_pairs(df: DataFrame, keep: Sequence[str] = (), null_fallback: bool = False) -> DataFrame:
    """Instruction rows to one user and one assistant message."""
    prompt = column_or(df, PROMPT_NAMES, null_fallback=null_fallback)
    answer = column_or(df, ANSWER_NAMES, null_fallback=null_fallback)
    return df.select(*keep, instruction_pair(prompt, answer).alias("messages"))


def chat_messages(df: DataFrame, chat: str = "chat") -> Column:
    """A string chat becomes one user message holding the whole string; a list is
    taken as it is; a missing column counts as an empty string."""
    if chat not in df.columns:
        return F.array(message("user", F.lit(""))).cast(MESSAGES)
    kind = df.schema[chat].dataType
    if isinstance(kind, T.StringType):
        return F.array(message("user", F.col(chat))).cast(MESSAGES)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(
            F.col(chat), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
        ).cast(MESSAGES)
    raise TypeError(f"column {chat} must be a string or a list of messages, not {kind.simpleString()}")


def mixed_messages(chat: Column | str) -> tuple[Column, Column]:
    """The messages of a VARIANT chat, and why it has none (null if it has).

    Each row is read by what it holds: a string becomes one user message, a list of objects with role and
    content its messages. Contents that are no strings are cast; a message without a role, or an
    element that is no object, makes the row an error.
    """
    c = F.col(chat) if isinstance(chat, str) else chat
    kind = F.schema_of_variant(c)
    text = F.array(message("user", F.try_variant_get(c, "$", "string"))).cast(MESSAGES)
    listed = F.try_variant_get(c, "$", MESSAGES)
    error = (
        F.when(c.isNull() | F.is_variant_null(c), "chat is null")
        .when(kind == "STRING", F.lit(None).cast("string"))
        .when(~kind.startswith("ARRAY<"), F.concat(F.lit("chat is "), kind))
        .when(listed.isNull() | F.exists(listed, lambda m: m.isNull()), "chat has an element that is no message")
        .when(F.exists(listed, lambda m: m["role"].isNull()), "chat has a message without a role")
    )
    return F.when(error.isNull(), F.when(kind == "STRING", text).otherwise(listed)), error


def canonical_chats(
    df: DataFrame, keep: Sequence[str] = (), system: str = "system", chat: str = "chat",
    on_null: str = "fail",
) -> DataFrame:
    """Chat rows to an optional system message followed by the chat.

    A null chat is not data the format knows: ``fail`` stops the job, ``drop``
    leaves the row out, ``flag`` keeps it with an ``error`` text. A VARIANT column may mix strings
    and lists; rows that hold something else are treated like null ones.
    """
    mixed = chat in df.columns and isinstance(df.schema[chat].dataType, T.VariantType)
    body, error = mixed_messages(chat) if mixed else (chat_messages(df, chat), None)
    head = system_prefix(F.col(system)) if system in df.columns else None
    messages = body if head is None else F.concat(head, body)
    if chat not in df.columns:
        return df.select(*keep, messages.alias("messages"))
    if error is None:
        error = F.when(F.col(chat).isNull(), "chat is null")
    missing = error.isNotNull()
    if on_null == "drop":
        return df.filter(~missing).select(*keep, messages.alias("messages"))
    if on_null == "flag":
        return df.select(
            *keep,
            F.when(~missing, messages).alias("messages"),
            error.alias("error"),
        )
    checked = F.when(missing, F.raise_error(error).cast(MESSAGES)).otherwise(messages)
    return df.select(*keep, checked.alias("messages"))


def mix_sources(*sources: DataFrame) -> DataFrame:
    """Concatenate sources in the given order, keeping duplicates.

    Order is carried by ``src_ord`` next to each source's own row key; nothing is
    sorted until a sink asks for it.
    """
    mixed = None
    for i, source in enumerate(sources):
        part = source.withColumn("src_ord", F.lit(i))
        mixed = part if mixed is None else mixed.unionByName(part)
    if mixed is None:
        raise ValueError("no sources given")
    return mixed


def nest_messages(
    rows: DataFrame, group: str = "conv_id", position: str = "turn",
    role: str = "role", content: str = "text", part_size: int | None = None,
) -> DataFrame:
    """Message rows to message arrays, in order: one row per conversation.

    With ``part_size`` a conversation comes as one row per stretch of so many positions,
    numbered by ``part``.
    """
    parts = [] if part_size is None else [whole_div(position, part_size).alias("part")]
    item = F.struct(
        F.col(position).alias("p"), F.col(role).alias("role"), F.col(content).alias("content")
    )
    nested = rows.groupBy(F.col(group), *parts).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return nested.select(
        group, *(["part"] if parts else []),
        F.transform(
            "items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))
        ).cast(MESSAGES).alias("messages"),
    )


def exchanges(
    rows: DataFrame, group: str = "conv_id", position: str = "turn",
    role: str = "role", content: str = "text",
) -> DataFrame:
    """Pair each user message with the assistant message right after it.

    Right after means the next row of the conversation, so positions may have gaps; an
    unanswered message has a null reply. Positions are unique within a conversation.
    """
    order = Window.partitionBy(group).orderBy(position)
    after = F.struct(F.col(role).alias("role"), F.col(content).alias("content"))
    paired = rows.select(group, position, role, F.col(content).alias("text"), F.lead(after).over(order).alias("_next"))
    reply = F.when(F.col("_next.role") == "assistant", F.col("_next.content"))
    return paired.filter(F.col(role) == "user").select(group, position, "text", reply.alias("reply"))
