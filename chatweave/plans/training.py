"""Training-set jobs: token rows to padded batches per rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.functions.tokens import TRAIN_MAX_LENGTH, truncate
from chatweave.operators.batching import Layout, batch_plan, pad_rows, place_rows


def placed_rows(
    tokens: DataFrame, key: str, ids: str, layout: Layout, seed: int = 0, epoch: int = 0,
    max_length: int = TRAIN_MAX_LENGTH, length: str | None = None,
) -> DataFrame:
    """Truncate, shuffle, deal and batch: the rows with their places, without pads.

    ``tokens`` is a stored table: it is read once for the plan and once for the ids.
    ``length`` may name a stored column with the number of ids, so that planning does
    not read the arrays.
    """
    cut = tokens.select(key, truncate(ids, max_length).alias("_ids"))
    size = F.col(length) if length else F.size(ids)
    sizes = tokens.select(key, F.least(size, F.lit(max_length)).cast("int").alias("_n"))
    return place_rows(cut, batch_plan(sizes, key, "_n", layout, seed, epoch), key, "_ids")


def training_batches(
    tokens: DataFrame, key: str, ids: str, layout: Layout, pad: int, seed: int = 0, epoch: int = 0,
    max_length: int = TRAIN_MAX_LENGTH, length: str | None = None,
) -> DataFrame:
    """``placed_rows``, padded. Empty rows stay, with length 0."""
    return pad_rows(placed_rows(tokens, key, ids, layout, seed, epoch, max_length, length), key, pad)


def _in_step_order(rows: DataFrame) -> DataFrame:
    order = ["rank", "step", "micro", "slot"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_batches(batches: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per rank, files in step order."""
    _in_step_order(batches).write.mode(mode).partitionBy("rank").parquet(path)


def write_training_batches(
    tokens: DataFrame, path: str, key: str, ids: str, layout: Layout, pad: int, seed: int = 0, epoch: int = 0,
    max_length: int = TRAIN_MAX_LENGTH, length: str | None = None, mode: str = "errorifexists",
) -> None:
    """``training_batches`` as files: ids are brought into step order first, and pads, mask and labels
    are made where they are written."""
    placed = placed_rows(tokens, key, ids, layout, seed, epoch, max_length, length)
    pad_rows(_in_step_order(placed), key, pad).write.mode(mode).partitionBy("rank").parquet(path)
