"""Replay of chat sessions from their inputs.

Inputs are rows ``(conv_id, turn, text, reply)``; a null reply is a failed
generation. Commands change the session: ``/clear`` empties the history,
``/system <text>`` sets the system message and empties it, ``/exit`` and ``/quit``
end it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.functions.messages import message, system_prefix
from chatweave.functions.text import classify_command, command_argument, strip
from chatweave.operators.joins import bounded_broadcast, join_null_safe
from chatweave.operators.ordered import CHUNK, Running, running, running_in_one_chunk, span_chunks
from chatweave.schemas import MESSAGES
from chatweave.session import cut_lineage

# The default system message and the history bound.
DEFAULT_SYSTEM = (
    "You are a helpful coding assistant. You write clean, efficient, and well-documented code."
)
MAX_MESSAGES = 20

# Positions per chunk: no task holds more of one session at a time.
SPAN = 4096


def read_inputs(inputs: DataFrame) -> DataFrame:
    """Strip and classify inputs; blank ones are dropped."""
    stripped = inputs.withColumn("u", strip("text")).filter(F.col("u") != "")
    kind = stripped.withColumn("cmd", classify_command("u"))
    return kind.withColumn("sys_arg", F.when(F.col("cmd") == "system", command_argument("u")))


def _answered() -> Column:
    return (F.col("cmd") == "turn") & F.col("reply").isNotNull()


def long_sessions(inputs: DataFrame, span: int = SPAN) -> DataFrame | None:
    """All chunks (session, chunk) that occur in sessions with rows outside their first
    chunk, or None if there are none.

    Chunks rather than sessions are listed, so that inputs meet them on a key that no
    session dominates. The list is materialised, as later steps look it up again.
    """
    outside = inputs.filter((F.col("turn") >= span) | (F.col("turn") < 0))
    if outside.isEmpty():
        return None
    found = span_chunks(inputs, "turn", span).select("conv_id", CHUNK).distinct()
    return cut_lineage(join_null_safe(found, outside.select("conv_id").distinct(), ["conv_id"], "left_semi"))


def _split(inputs: DataFrame, span: int) -> tuple[DataFrame, DataFrame | None]:
    """Chunked inputs of sessions within one chunk, and those of longer ones if any."""
    rows, chunks = span_chunks(inputs, "turn", span), long_sessions(inputs, span)
    if chunks is None:
        return rows, None
    chunks, key = bounded_broadcast(chunks), ["conv_id", CHUNK]
    return join_null_safe(rows, chunks, key, "left_anti"), join_null_safe(rows, chunks, key, "left_semi")


def _state(inputs: DataFrame, default_system: str, chunked: bool) -> DataFrame:
    rows = read_inputs(inputs)
    values = {
        "exits": Running("sum", (F.col("cmd") == "exit").cast("long")),
        "epoch": Running("sum", F.col("cmd").isin("clear", "system").cast("long")),
        "sys": Running("last", F.col("sys_arg")),
        "k": Running("sum", _answered().cast("long"), inclusive=False),
    }
    add = running if chunked else running_in_one_chunk
    state = add(rows, ["conv_id"], ["turn"], values)
    return state.withColumn("sys", F.coalesce("sys", F.lit(default_system)))


def session_state(inputs: DataFrame, default_system: str = DEFAULT_SYSTEM, span: int = SPAN) -> DataFrame:
    """Per input: ``exits`` so far, ``epoch`` (resets so far), ``sys`` (system message
    in force) and ``k`` (answered inputs before this one).

    Sessions within one chunk take plain windows; longer ones are split into chunks.
    """
    short, long = _split(inputs, span)
    state = _state(short, default_system, chunked=False)
    return state if long is None else state.unionByName(_state(long, default_system, chunked=True))


def open_inputs(state: DataFrame) -> DataFrame:
    """Inputs before the session's first exit."""
    return state.filter(F.col("exits") == 0)


def _turns(inputs: DataFrame, default_system: str, chunked: bool) -> DataFrame:
    state = open_inputs(_state(inputs, default_system, chunked))
    return state.filter(F.col("cmd") == "turn").select(
        "conv_id", "turn", CHUNK, "epoch", "sys", "k", "u", "reply"
    )


def checked_messages(n: int) -> int:
    """A history bound: positive and even, as history comes in pairs."""
    if n <= 0 or n % 2:
        raise ValueError("max_messages must be positive and even")
    return n


def _pair() -> Column:
    """The two messages an answered input adds to the history."""
    return F.array(message("user", "u"), message("assistant", "reply")).cast(MESSAGES)


def _recent_pairs(turns: DataFrame, pairs: int) -> DataFrame:
    """Add ``past``: the last answered pairs before each turn within its chunk.

    Answered inputs enter the history as pairs, so the bound is a range over the
    count ``k`` of answered inputs; failed ones between them do not shorten it.
    """
    recent = Window.partitionBy("conv_id", CHUNK, "epoch").orderBy("k").rangeBetween(-pairs, -1)
    pair = F.when(F.col("reply").isNotNull(), _pair())
    return turns.withColumn("past", F.collect_list(pair).over(recent))


def _add_earlier_chunks(turns: DataFrame, held: DataFrame, pairs: int) -> DataFrame:
    """Complete ``past`` with pairs from earlier chunks of the session.

    Each chunk passes on at most ``pairs`` rows and asks for at most ``pairs`` rows, by
    their count, so both sides of the join are small.
    """
    newest = Window.partitionBy("conv_id", CHUNK).orderBy(F.desc("k"))
    carriers = (
        turns.filter(F.col("reply").isNotNull())
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= pairs)
        .select("conv_id", F.col("k").alias("pk"), F.col("epoch").alias("pe"), _pair().alias("pair"))
    )
    starts = turns.groupBy("conv_id", CHUNK).agg(F.min("k").alias("k0"))
    wanted = starts.filter(F.col("k0") > 0).select(
        "conv_id", CHUNK, "k0",
        F.explode(F.sequence(F.greatest(F.col("k0") - pairs, F.lit(0)), F.col("k0") - 1)).alias("pk"),
    )
    item = F.struct(F.col("pk").alias("k"), F.col("pe").alias("epoch"), "pair")
    carried = (
        join_null_safe(wanted, carriers, ["conv_id", "pk"], "inner")
        .groupBy("conv_id", CHUNK)
        .agg(F.sort_array(F.collect_list(item)).alias("halo"), F.first("k0").alias("k0"))
    )
    epoch, k = F.col("epoch"), F.col("k")
    usable = F.filter(F.col("halo"), lambda h: (h["epoch"] == epoch) & (h["k"] >= k - pairs))
    # Only the first turns of a chunk look back beyond it.
    earlier = F.when(k - F.lit(pairs) < F.col("k0"), F.transform(usable, lambda h: h["pair"]))
    return join_null_safe(held, carried, ["conv_id", CHUNK]).withColumn(
        "past", F.concat(F.coalesce(earlier, F.slice("past", 1, 0)), F.col("past"))
    )


def turn_context(
    inputs: DataFrame, default_system: str = DEFAULT_SYSTEM,
    max_messages: int = MAX_MESSAGES, span: int = SPAN,
) -> DataFrame:
    """The message list sent to the model for every user turn: system message, the
    last ``max_messages`` history messages, the input.

    Sessions within one chunk need one shuffle by session. Longer sessions are worked
    on in chunks, and only their turns are materialised, as three steps read them.
    """
    pairs = checked_messages(max_messages) // 2
    short, long = _split(inputs, span)
    held = _recent_pairs(_turns(short, default_system, chunked=False), pairs)
    if long is not None:
        turns = cut_lineage(_turns(long, default_system, chunked=True))
        whole = _add_earlier_chunks(turns, _recent_pairs(turns, pairs), pairs)
        held = held.unionByName(whole.drop("halo", "k0"))
    messages = F.concat(
        system_prefix("sys"), F.flatten("past"), F.array(message("user", "u")).cast(MESSAGES)
    )
    return held.select("conv_id", "turn", messages.alias("messages"))


def idle_contexts(
    inputs: DataFrame, at: str, idle: str, default_system: str = DEFAULT_SYSTEM,
    max_messages: int = MAX_MESSAGES, span: int = SPAN,
) -> DataFrame:
    """``turn_context`` of sessions that end when they get no input for ``idle``.

    The next input starts with an empty history and the default system message, also
    after an exit. Blank inputs are none; times rise with the turns.
    """
    taken = span_chunks(inputs.filter(strip("text") != ""), "turn", span)
    seconds = F.col(at).cast("double")
    before = running(taken.withColumn("_s", seconds), ["conv_id"], ["turn"],
                     {"_before": Running("last", F.col("_s"), inclusive=False)})
    gap = F.coalesce(F.col("_s") - F.col("_before") > pd.Timedelta(idle).total_seconds(), F.lit(False))
    numbered = running(before.withColumn("_gap", gap.cast("long")), ["conv_id"], ["turn"], {"_session": Running("sum", F.col("_gap"))})
    key = F.struct(F.col("conv_id").alias("id"), F.col("_session").alias("session"))
    rows = numbered.select(key.alias("conv_id"), "turn", "text", "reply")
    return turn_context(rows, default_system, max_messages, span).withColumn("conv_id", F.col("conv_id.id"))


def last_message_rows(
    rows: DataFrame, group: str = "conv_id", position: str = "turn", n: int = MAX_MESSAGES
) -> DataFrame:
    """The last ``n`` message rows of each conversation (cut down before the shuffle)."""
    newest = Window.partitionBy(group).orderBy(F.desc(position))
    return rows.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")
