"""Vocabulary fitting, encoding and decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.functions.tokens import pad_id, without_ids
from chatweave.operators.ordered import global_index
from chatweave.session import cut_lineage

# Ids below the first piece id, in this order.
SPECIALS = ("<unk>", "<eos>", "<pad>")
UNK_ID, EOS_ID, PAD_ID = 0, 1, 2

# Vocabularies up to this many pieces are shipped to the workers; larger ones are
# joined by shuffle.
SHIPPED_PIECES = 500_000

# Elements that are looked up at once in a task.
SLICE = 200_000

# Pieces of a large vocabulary that are broadcast; its ids follow frequency.
HEAD_PIECES = 100_000


def fit_vocabulary(pieces: DataFrame, column: str, size: int, first_id: int = len(SPECIALS)) -> DataFrame:
    """The ``size`` most frequent pieces of an array column: ``(piece, id, n)``.

    Ids follow count, then the piece in binary order. Counting combines on the map
    side, so a frequent piece does not load one task. The least count that can be among
    the ``size`` comes from the number of pieces per count; only pieces that have it are
    ranked.
    """
    # An outer explode: the inner one makes the optimizer test the array's size in a
    # filter at the scan, which splits every text once more per test.
    exploded = pieces.select(F.explode_outer(column).alias("piece")).filter(F.col("piece").isNotNull())
    counts = exploded.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts)
    # How many pieces have each count; a cumulative sum from the top gives the least count kept.
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pieces"))
    before = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    least = (sizes.withColumn("above", F.coalesce(F.sum("pieces").over(before), F.lit(0)))
             .filter(F.col("above") < size).agg(F.min("n").alias("n")).first()["n"])
    survivors = counts.filter(F.col("n") >= F.lit(least)) if least is not None else counts.limit(0)
    ranked = global_index(survivors.withColumn("_order", -F.col("n")), ["_order", "piece"])
    chosen = ranked.filter(F.col("idx") < size)
    return chosen.select("piece", (F.col("idx") + F.lit(first_id)).cast("int").alias("id"), "n")


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary held as Arrow arrays, small enough to ship to the workers."""

    pieces: pa.Array
    ids: pa.Array
    unk: int = UNK_ID
    eos: int = EOS_ID
    pad: int | None = None

    @property
    def pad_id(self) -> int:
        return pad_id(self.pad, self.eos)

    @property
    def special_ids(self) -> tuple[int, ...]:
        return tuple(range(len(SPECIALS)))

    def __len__(self) -> int:
        return len(self.pieces)


def ship_vocabulary(vocab: DataFrame, limit: int = SHIPPED_PIECES) -> Vocabulary | None:
    """The vocabulary as Arrow arrays, or None if it has more than ``limit`` pieces."""
    table = vocab.select("piece", F.col("id").cast("int").alias("id")).limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return None
    table = table.combine_chunks()
    return Vocabulary(
        pa.array(table["piece"].to_pylist(), pa.string()), pa.array(table["id"].to_pylist(), pa.int32())
    )


def _list_of(values: pa.Array, like: pa.Array) -> pa.Array:
    """A list array with the row lengths of ``like`` and new flat values."""
    lengths = pc.fill_null(pc.list_value_length(like), 0)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of list arrays, in slices of at most ``SLICE`` elements or one row: what a lookup
    holds besides a batch does not grow with the batch."""
    for column in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(column):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            yield column.slice(at, stop - at)
            at = stop
        if not len(column):
            yield column
        del column
        pa.default_memory_pool().release_unused()


def _flat_lookup(known: dict, missing, kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """List elements by a dictionary built once; each different element of a slice is
    looked up once."""

    def look(column: pa.Array) -> pa.Array:
        once = column.flatten().dictionary_encode()
        found = pa.array([known.get(x, missing) for x in once.dictionary.to_pylist()], kind)
        return _list_of(pc.fill_null(pc.take(found, once.indices), missing), column)

    return look


def encoder(vocab: Vocabulary) -> Callable[[Column | str], Column]:
    """Pieces to ids as an Arrow function: one lookup table per task, no shuffle."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        look = _flat_lookup(dict(zip(vocab.pieces.to_pylist(), vocab.ids.to_pylist())), vocab.unk, pa.int32())
        for column in _slices(batches):
            yield look(column)

    return encode


def decoder(vocab: Vocabulary) -> Callable[[Column | str], Column]:
    """Ids to pieces; ids outside the vocabulary give the unknown mark."""

    @F.arrow_udf("array<string>")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = dict(zip(vocab.ids.to_pylist(), vocab.pieces.to_pylist()))
        look = _flat_lookup(known, SPECIALS[UNK_ID], pa.string())
        for column in _slices(batches):
            yield look(column)

    return decode


def _lookup_by_join(
    df: DataFrame, column: str, table: DataFrame, left: str, right: str, missing: Column, out: str,
) -> DataFrame:
    """Look every element up by joins and rebuild the arrays.

    Rows get an id of their own, fixed in the shared folder, so no key of the caller
    matters. Ids follow frequency: the ``HEAD_PIECES`` first are broadcast, and only the
    elements that are not among them are shuffled.
    """
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    items = rows.select("_row", F.posexplode_outer(column).alias("_pos", left)).filter(F.col("_pos").isNotNull())
    head = table.filter(F.col("id") < HEAD_PIECES).select(left, F.struct(right).alias("_found"))
    met = items.join(F.broadcast(head), left, "left")
    near = met.filter(F.col("_found").isNotNull()).select("_row", "_pos", F.col(f"_found.{right}").alias("_v"))
    rest = table.filter(F.col("id") >= HEAD_PIECES).select(left, right)
    far = met.filter(F.col("_found").isNull()).join(rest, left, "left").select(
        "_row", "_pos", F.coalesce(right, missing).alias("_v"))
    rebuilt = near.unionByName(far).groupBy("_row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_v"))), lambda x: x["_v"]).alias("_new")
    )
    # Rows with empty arrays have no items, hence the outer join.
    empty = F.when(F.col(column).isNotNull(), F.slice(F.array(missing), 1, 0))
    return rows.join(rebuilt, "_row", "left").withColumn(out, F.coalesce("_new", empty)).drop("_new", "_row")


def encode(
    df: DataFrame, key: str, column: str, vocab: DataFrame, out: str = "input_ids",
    limit: int = SHIPPED_PIECES,
) -> DataFrame:
    """Pieces to ids for every row; unknown pieces get the unknown id.

    Keys may repeat or be null; rows are told apart by ids of their own.
    """
    shipped = ship_vocabulary(vocab, limit)
    if shipped is not None:
        return df.withColumn(out, encoder(shipped)(F.col(column)))
    ids = vocab.select("piece", F.col("id").cast("int").alias("id"))
    return _lookup_by_join(df, column, ids, "piece", "id", F.lit(UNK_ID), out)


def decode(
    df: DataFrame, key: str, column: str, vocab: DataFrame, out: str = "text",
    skip_specials: bool = True, separator: str = " ", limit: int = SHIPPED_PIECES,
) -> DataFrame:
    """Ids back to text, leaving special ids out."""
    ids = F.col(column)
    if skip_specials:
        ids = without_ids(ids, tuple(range(len(SPECIALS))))
    held = df.withColumn("_ids", ids)
    shipped = ship_vocabulary(vocab, limit)
    if shipped is not None:
        found = held.withColumn("_pieces", decoder(shipped)(F.col("_ids")))
    else:
        table = vocab.select(F.col("id").cast("int").alias("id"), "piece")
        found = _lookup_by_join(held, "_ids", table, "id", "piece", F.lit(SPECIALS[UNK_ID]), "_pieces")
    return found.withColumn(out, F.array_join("_pieces", separator)).drop("_ids", "_pieces")
