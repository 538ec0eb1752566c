"""Preparation jobs: sources to rendered, encoded and truncated rows."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.functions.messages import render, render_message
from chatweave.functions.tokens import (
    PIECE_PATTERN,
    PREPARE_MAX_LENGTH,
    TRAIN_MAX_LENGTH,
    attention_mask,
    pieces,
    truncate,
)
from chatweave.operators.canonical import canonical_chats, canonical_pairs, mix_sources
from chatweave.operators.joins import join_null_safe
from chatweave.operators.vocabulary import encode
from chatweave.session import spread
from chatweave.sources.tables import read_in_storage_order, read_prefix, write_columns

# Rows taken from the two sources.
PAIR_ROWS = 800_000
CHAT_ROWS = 200_000


def conversation_tokens(rows: DataFrame, max_length: int = TRAIN_MAX_LENGTH) -> DataFrame:
    """Per conversation: messages, pieces of the rendered text, and its first
    ``max_length`` pieces, from message rows.

    Pieces never cross a message border of the template, so messages are counted one by
    one. Every message has at least one piece, so only the first ``max_length`` messages
    of a conversation can reach the kept prefix; they are cut out by row number, on the map
    side first, and the rest is counted, not collected. Texts travel rather than pieces,
    which take several times the room; of a message with more than ``max_length`` pieces
    only these travel, joined by blanks, and split to the same pieces again. Positions may
    have gaps.
    """
    rendered = spread(rows, "conv_id", "turn").select(
        "conv_id", "turn", render_message(F.col("role"), F.col("text")).alias("x")
    )
    counted = rendered.withColumn("n", F.regexp_count("x", F.lit(PIECE_PATTERN)))
    long = F.array_join(truncate(pieces("x"), max_length), " ")
    text = F.when(F.col("n") <= max_length, F.col("x")).otherwise(long)
    sizes = counted.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(F.col("n").cast("long")).alias("n_tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn")
    first = counted.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= max_length)
    heads = first.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_r", text.alias("x")))).alias("head"))
    grouped = join_null_safe(sizes, heads, ["conv_id"])
    joined = F.array_join(F.transform("head", lambda h: h["x"]), "\n")
    return grouped.select(
        "conv_id", "n_messages", "n_tokens", truncate(pieces(joined), max_length).alias("pieces")
    )


def rendered_rows(canonical: DataFrame, keep: tuple[str, ...] = ("src_ord", "row_ord"),
                  default_system: str | None = None) -> DataFrame:
    """Canonical rows to text rows; only the keys and the text survive."""
    return canonical.select(*keep, render("messages", default_system).alias("text"))


def encoded_rows(rendered: DataFrame, vocab: DataFrame, key: str, max_length: int = PREPARE_MAX_LENGTH) -> DataFrame:
    """Text rows to ids and mask; the text is kept.

    Pieces are cut to the limit before the lookup, as each gives one id.
    """
    cut = rendered.withColumn("_pieces", truncate(pieces("text"), max_length))
    ids = encode(cut, key, "_pieces", vocab)
    return ids.withColumn("attention_mask", attention_mask("input_ids")).drop("_pieces")


@dataclass(frozen=True)
class WriteReport:
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> WriteReport:
    """Write a dataset and count its rows in the same job."""
    seen = Observation("progress")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    started = time.monotonic()
    write_columns(counted, path, mode)
    return WriteReport(seen.get["rows"], time.monotonic() - started)


def prepare_dataset(
    pairs: DataFrame, chats: DataFrame, pair_rows: int | None = PAIR_ROWS,
    chat_rows: int | None = CHAT_ROWS, default_system: str | None = None,
) -> DataFrame:
    """Slice, canonicalise, concatenate and render the two sources.

    Both have a ``row_ord`` key; a row count of None takes a source as it is. Rows get
    ``key`` = source and row.
    """

    def prefix(source: DataFrame, n: int | None) -> DataFrame:
        return source if n is None else read_prefix(source, ["row_ord"], n)

    first = canonical_pairs(prefix(pairs, pair_rows), keep=("row_ord",))
    second = canonical_chats(prefix(chats, chat_rows), keep=("row_ord",))
    text = rendered_rows(mix_sources(first, second), default_system=default_system)
    return text.withColumn("key", F.concat_ws("-", "src_ord", "row_ord"))


def prepare_from_files(
    spark: SparkSession, pairs: str, chats: str, pair_rows: int = PAIR_ROWS, chat_rows: int = CHAT_ROWS,
    default_system: str | None = None,
) -> DataFrame:
    """The same from two parquet paths, cut in storage order."""
    first = read_in_storage_order(spark, pairs, pair_rows)
    second = read_in_storage_order(spark, chats, chat_rows)
    return prepare_dataset(first, second, None, None, default_system)


def run_prepare(
    spark: SparkSession, pairs: DataFrame, chats: DataFrame, vocab: DataFrame, path: str,
    **options,
) -> WriteReport:
    """Prepare, encode and write the dataset."""
    rendered = prepare_dataset(pairs, chats, **options)
    return write_counted(encoded_rows(rendered, vocab, "key"), path)
