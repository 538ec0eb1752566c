"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash up to a fixed fraction of the hash range, whatever the length of the
document, so its size follows the document and the sketches of very unequal documents can be compared and
merged. A document without a hash in that fraction keeps its lowest one. ``bound`` says up to where a sketch
is complete: the fraction, or the lowest hash where that is above it; two sketches are compared
below the lower of their bounds. The estimate's error is that of a sample of ``fraction`` of the shingles.

Defined cases: null text is the empty text, with the empty sketch; two empty sketches are
alike (1), an empty and another are not (0); a text of fewer than five words is one
shingle. Equal texts have equal sketches. Repeated rows and ids stay rows of their own. An
empty table gives an empty table. Extra columns pass through, but ``_sketch`` and ``_next`` give way to the results.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatweave.llm.columns import let, shingle_hashes

LOWEST, HIGHEST = -(2**63), 2**63 - 1
FRACTION = 1 / 2


def sketch(text: Column, fraction: float = FRACTION) -> Column:
    """Struct of ``bound`` and sorted ``hashes``: all distinct shingle hashes up to ``bound``."""
    limit = F.lit(LOWEST + int(fraction * 2**64))

    def cut(h: Column) -> Column:
        bound = F.when(F.size(h) == 0, F.lit(HIGHEST)).otherwise(F.greatest(limit, F.array_min(h)))
        return let(bound, lambda b: F.struct(
            b.alias("bound"), F.array_sort(F.array_distinct(F.filter(h, lambda x: x <= b))).alias("hashes")))

    return let(shingle_hashes(text), cut)


def merge(a: Column, b: Column) -> Column:
    """The sketch of both documents' shingles together."""
    bound = F.least(a["bound"], b["bound"])
    both = F.array_sort(F.array_union(a["hashes"], b["hashes"]))
    return F.struct(bound.alias("bound"), F.filter(both, lambda x: x <= bound).alias("hashes"))


def _common(a: Column, b: Column, use) -> Column:
    bound = F.least(a["bound"], b["bound"])
    return let(F.filter(a["hashes"], lambda x: x <= bound), lambda p: let(
        F.filter(b["hashes"], lambda x: x <= bound), lambda q: use(
            F.size(p), F.size(q), F.size(F.array_intersect(p, q)))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two documents, from 0 to 1."""
    return _common(a, b, lambda p, q, both: F.when((p == 0) & (q == 0), F.lit(1.0)).otherwise(
        both / (p + q - both)).cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 for an empty ``a``, null where
    both sketches are complete only below all hashes of ``a``."""
    return _common(a, b, lambda p, q, both: F.when(F.size(a["hashes"]) == 0, F.lit(1.0)).when(
        p > 0, both / p).cast("double"))


def as_text(s: Column) -> Column:
    """``bound:hash,hash,...`` in hexadecimal."""
    return F.concat(F.lower(F.hex(s["bound"])), F.lit(":"), F.array_join(
        F.transform(s["hashes"], lambda x: F.lower(F.hex(x))), ","))


def fingerprints(docs: DataFrame, text_col: str = "text", fraction: float = FRACTION) -> DataFrame:
    """``docs`` with a ``_sketch`` column; an input column of that name gives way to it."""
    return docs.drop("_sketch").select(F.struct("*").alias("row"), sketch(
        F.coalesce(F.col(text_col), F.lit("")), fraction).alias("_sketch")).select("row.*", "_sketch")


def _chunk(key: Column, bounds: list) -> Column:
    """The number of bounds at or below ``key``, found in two steps; -1 for null."""
    if not bounds:
        return F.when(key.isNull(), -1).otherwise(0)
    width = isqrt(len(bounds)) + 1
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    table = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    coarse = F.size(F.filter(heads, lambda b: b <= key))
    return F.when(key.isNull(), -1).otherwise(let(coarse, lambda c: F.when(c == 0, 0).otherwise(
        (c - 1) * width + F.size(F.filter(F.get(table, c - 1), lambda b: b <= key)))))


def with_next(docs: DataFrame, id_col: str, carried: list[str],
              derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``derive(docs)`` with ``_next``: its columns ``carried`` of the next row by falling id;
    the last row gets those of the first. ``derive`` adds columns row by row, before the shuffle.

    Rows of one id are taken by falling first carried column, null ids come last. Ids are cut into
    chunks of about equal size (their bounds are quantiles, as many as eight times the
    shuffle partitions), rows are shuffled once by chunk, and each chunk also gets the
    first row of the chunk below. No task sees more than its chunks.
    """
    spark, docs = docs.sparkSession, docs.drop("_next")
    n = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).cast("bigint").alias("id"))
    bounds = ids.agg(F.percentile_approx(
        "id", [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("b")).first()["b"]
    bounds = sorted(set(bounds or []))
    # At most one row per chunk.
    heads = sorted(ids.groupBy(_chunk(F.col("id"), bounds).alias("chunk")).agg(
        F.max("id").alias("head")).collect(), reverse=True)
    if not heads:
        full = derive(docs)
        return full.withColumn("_next", F.lit(None).cast(full.select(F.struct(*carried)).dtypes[0][1]))
    above = [(h["head"], heads[i - 1]["chunk"]) for i, h in enumerate(heads)]
    place = F.broadcast(spark.createDataFrame(above, "_head bigint, _chunk int"))

    def shaped(df: DataFrame) -> DataFrame:
        return derive(df).select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"))

    carry = F.struct(*[F.col("row")[c].alias(c) for c in carried])
    own = shaped(docs)
    heads_only = docs.join(place, F.col(id_col).cast("bigint").eqNullSafe(F.col("_head")), "left_semi")
    first = (shaped(heads_only).join(place, F.col("id").eqNullSafe(F.col("_head")))
             .groupBy(F.col("_chunk").alias("chunk"), "id").agg(F.max_by("row", carry).alias("row")))
    rows = (own.withColumn("chunk", _chunk(F.col("id"), bounds)).withColumn("given", F.lit(0))
            .unionByName(first.withColumn("given", F.lit(1))))
    order = Window.partitionBy("chunk").orderBy(
        F.col("given"), F.col("id").desc_nulls_last(), F.col("carry").desc_nulls_last())
    # Dealt out before what is carried is taken from the row, so that it is not shuffled beside it.
    dealt = rows.repartition("chunk").withColumn("carry", carry)
    return (dealt.withColumn("_next", F.lead("carry").over(order)).filter(F.col("given") == 0)
            .select("row.*", "_next"))
