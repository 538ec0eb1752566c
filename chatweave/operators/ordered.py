"""Running values, global positions and prefixes without one-task windows.

A running value over a large ordered group is computed in chunks: each chunk is
summed (map-side combined), the per-chunk sums are accumulated, and every row
adds the carry of its chunk to the running value inside the chunk. The rows
themselves are shuffled once, by (group, chunk), so a group holding a large share
of the table is spread over its chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.functions.numbers import whole_div
from chatweave.operators.joins import join_null_safe
from chatweave.session import cut_lineage

CHUNK = "_chunk"

# Up to this many rows an ordered prefix is a top-n, whose last task gets as many rows
# from every partition.
HEAD_IN_ONE_TASK = 1_000


@dataclass(frozen=True)
class Running:
    """One running value: a ``sum``, or the ``last`` value that is not null."""

    kind: str
    value: Column
    inclusive: bool = True


def _sum_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    values: dict[str, Running],
    totals: Sequence[str] = (),
) -> DataFrame:
    """Add running values over ``group`` in ``order``; ``df`` has a ``CHUNK`` column
    that never decreases along the order.

    ``totals`` names sums whose group total is added as ``<name>_total``.
    """
    group = list(group)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    order_key = F.struct(*[F.col(c) for c in order if isinstance(c, str)])

    partials = []
    for name, r in values.items():
        if r.kind == "sum":
            partials.append(F.sum(r.value).alias(name))
        else:
            key = F.when(r.value.isNotNull(), order_key)
            partials.append(F.max_by(r.value, key).alias(name))
    per_chunk = df.groupBy(*group, CHUNK).agg(*partials)

    # One row per chunk from here on, not one per input row.
    before = Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    carries = []
    for name, r in values.items():
        if r.kind == "sum":
            carries.append(F.sum(name).over(before).alias(f"_carry_{name}"))
        else:
            carries.append(F.last(name, ignorenulls=True).over(before).alias(f"_carry_{name}"))
    carries += [F.sum(name).over(whole).alias(f"{name}_total") for name in totals]
    carry = per_chunk.select(*group, CHUNK, *carries)
    if not group:
        # A global order has as many carry rows as it has chunks, which the
        # chunking rule bounds (hash prefixes or shuffle partitions).
        carry = F.broadcast(carry)
    joined = join_null_safe(df, carry, [*group, CHUNK])

    inside = Window.partitionBy(*group, CHUNK).orderBy(*order_cols)
    out = []
    for name, r in values.items():
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1)
        held = F.col(f"_carry_{name}")
        if r.kind == "sum":
            local = F.sum(r.value).over(frame)
            out.append((_sum_or_zero(held) + _sum_or_zero(local)).alias(name))
        else:
            local = F.last(r.value, ignorenulls=True).over(frame)
            out.append(F.coalesce(local, held).alias(name))
    kept = [c for c in df.columns if c not in values]
    return joined.select(*kept, *out, *[f"{name}_total" for name in totals])


def running_in_one_chunk(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: dict[str, Running]
) -> DataFrame:
    """The same values by plain windows, for groups known to be of bounded size."""
    over = Window.partitionBy(*group, CHUNK).orderBy(*order)
    kinds = {"sum": lambda c: F.sum(c), "last": lambda c: F.last(c, ignorenulls=True)}
    out = []
    for name, r in values.items():
        frame = over.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1)
        value = kinds[r.kind](r.value).over(frame)
        out.append((_sum_or_zero(value) if r.kind == "sum" else value).alias(name))
    return df.select(*[c for c in df.columns if c not in values], *out)


def span_chunks(df: DataFrame, position: str, span: int) -> DataFrame:
    """Chunks of ``span`` consecutive integer positions."""
    return df.withColumn(CHUNK, whole_div(position, span))


def hash_chunks(df: DataFrame, digest: str, digits: int = 3) -> DataFrame:
    """Chunks by the leading hex digits of a digest used as the order: 16**digits
    chunks of nearly equal size, in digest order. At most four digits, as the carries
    of the chunks are broadcast."""
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    return df.withColumn(CHUNK, F.substring(F.col(digest), 1, digits))


def range_chunks(df: DataFrame, keys: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Chunks that are the range partitions of ``keys``.

    Range bounds come from a sample, so the partitions are materialised once in the
    shared folder: every later read sees the same chunks. Pass narrow rows.
    """
    args = [partitions] if partitions else []
    ranged = df.repartitionByRange(*args, *keys)
    return cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))


def global_index(
    df: DataFrame, keys: Sequence[str], name: str = "idx", partitions: int | None = None
) -> DataFrame:
    """0-based position of each row in the order of ``keys`` (unique).

    Rows are range-partitioned, sorted and numbered inside their partition in one go,
    then materialised like ``range_chunks``; the offsets of the partitions are one
    small row each. One shuffle in all.
    """
    args = [partitions] if partitions else []
    in_order = df.repartitionByRange(*args, *keys).sortWithinPartitions(*keys)
    # The lower 33 bits of the generated id count the rows of a partition.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut_lineage(
        in_order.withColumn(CHUNK, F.spark_partition_id()).withColumn("_position", position)
    )
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(CHUNK, _sum_or_zero(F.sum("_size").over(before)).alias("_offset"))
    found = placed.join(F.broadcast(offsets), CHUNK)
    return found.withColumn(name, F.col("_offset") + F.col("_position")).drop(
        CHUNK, "_position", "_offset"
    )


def enumerate_rows(
    df: DataFrame, keys: Sequence[str], name: str = "n", start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows from ``start`` in the order of ``keys`` (unique)."""
    indexed = global_index(df, keys, name, partitions)
    return indexed.withColumn(name, F.col(name) + F.lit(start))


def head_slice(
    df: DataFrame, keys: Sequence[str], n: int, in_one_task: int = HEAD_IN_ONE_TASK
) -> DataFrame:
    """The first ``n`` rows in the order of ``keys``, null before all values; a shorter
    input comes back whole. Of rows that share the last key, as many as fit come, any of them.

    A small prefix is a top-n. A large one looks up the n-th key on the key columns
    alone and filters by it, so the rows themselves are not shuffled and the bound
    on the leading key reaches the scan. For an integer leading key only keys up to a
    quantile somewhat above the n-th are numbered.
    """
    if n <= max(in_one_task, 0):
        return df.orderBy(*keys).limit(n)
    indexed = global_index(_below_quantile(df.select(*keys), keys[0], n), keys)
    last = indexed.filter(F.col("idx") == n - 1).select(*keys).first()
    if last is None:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    bound = F.struct(*[F.lit(last[k]).cast(types[k]).alias(k) for k in keys])
    row, lead = F.struct(*[F.col(k) for k in keys]), F.col(keys[0])
    reach = lead.isNull() if last[keys[0]] is None else lead.isNull() | (lead <= F.lit(last[keys[0]]))
    lower = df.filter(reach & (row < bound))
    equal = df.filter(reach & row.eqNullSafe(bound))
    same = indexed.filter(F.struct(*[F.col(k) for k in keys]).eqNullSafe(bound)).agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("first")).first()
    room = n - same["first"]
    return df.filter(reach & (row <= bound)) if same["n"] == room else lower.unionByName(equal.limit(room))


def _below_quantile(keys: DataFrame, lead: str, n: int) -> DataFrame:
    """Keys up to a bound that at least ``n`` rows do not exceed; all keys if none is found."""
    if keys.schema[lead].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return keys
    total = keys.agg(F.count(F.lit(1)).alias("n"), F.count(lead).alias("known")).first()
    if n >= total["n"]:
        return keys
    share = min(1.0, n / max(1, total["known"]) * 1.02 + 0.001)
    bound = keys.agg(F.percentile_approx(lead, share, 10_000).alias("b")).first()["b"]
    if bound is None:
        return keys
    near = keys.filter(F.col(lead).isNull() | (F.col(lead) <= F.lit(bound)))
    return near if near.count() >= n else keys


def byte_shards(
    df: DataFrame, key: str, size: str, cap: int, name: str = "shard",
    max_row_bytes: int = 0, partitions: int | None = None,
) -> DataFrame:
    """Shard number of each row of ``(key, size)``: bytes before it divided by the cap.

    A shard may exceed ``cap`` by less than one row; giving ``max_row_bytes`` (below
    the cap) keeps every shard within it.
    """
    if not 0 <= max_row_bytes < cap:
        raise ValueError("max_row_bytes must be smaller than cap")
    chunked = range_chunks(df.select(key, size), [key], partitions)
    summed = running(
        chunked, [], [key],
        {"bytes_before": Running("sum", F.col(size).cast("long"), inclusive=False)},
    )
    share = whole_div("bytes_before", cap - max_row_bytes)
    return summed.withColumn(name, share).drop(CHUNK)
