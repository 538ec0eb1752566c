"""Length and vocabulary statistics per group: exactly, or by sketches that merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 400
HLL_BITS = 14


def length_stats(rows: DataFrame, group: str, pieces: str) -> DataFrame:
    """Per group: rows, pieces, longest row, median and 90 % quantile of the lengths, distinct pieces.

    Each row gives its length and its different pieces at once, so texts are split once and meet in one
    shuffle, summed up on the map side. Quantiles are those of the histogram of lengths, hence exact.
    """
    length = F.struct(F.lit(None).cast("string").alias("piece"), F.size("p").alias("n"))
    seen = F.transform(F.array_distinct("p"), lambda x: F.struct(x.alias("piece"), F.lit(None).cast("int").alias("n")))
    # An outer explode of one column of pieces: they are not split a second time.
    each = rows.select(F.col(group).alias("g"), F.col(pieces).alias("p")).select(
        "g", F.explode_outer(F.concat(F.array(length), F.coalesce(seen, F.array().cast("array<struct<piece:string,n:int>>")))).alias("x"))
    counted = each.groupBy("g", "x.piece", "x.n").agg(F.count(F.lit(1)).alias("times"))
    is_length = F.col("piece").isNull() & F.col("n").isNotNull()
    often = F.when(is_length, F.col("times")).otherwise(F.lit(0))
    return counted.groupBy("g").agg(
        F.sum(often).alias("n_docs"),
        F.sum(F.when(is_length, F.col("n").cast("long") * F.col("times")).otherwise(F.lit(0))).alias("n_tokens"),
        F.max("n").alias("longest"),
        F.percentile(F.col("n"), 0.5, often).alias("p50"),
        F.percentile(F.col("n"), 0.9, often).alias("p90"),
        F.count("piece").alias("n_distinct"),
    ).withColumnRenamed("g", group)


def length_sketches(rows: DataFrame, parts: list[str], pieces: str) -> DataFrame:
    """Per part: rows, pieces, and sketches of the lengths (quantiles) and of the different pieces.

    Of fixed size whatever the part; to be stored and merged later, for any union of parts.
    """
    sizes = rows.select(*parts, F.col(pieces).alias("p")).groupBy(*parts).agg(
        F.count("p").alias("n_docs"), F.sum(F.size("p").cast("long")).alias("n_tokens"), F.max(F.size("p")).alias("longest"),
        F.kll_sketch_agg_bigint(F.size("p").cast("long"), F.lit(KLL_SIZE)).alias("lengths"))
    kinds = rows.select(*parts, F.explode_outer(pieces).alias("piece")).groupBy(*parts).agg(
        F.hll_sketch_agg("piece", HLL_BITS).alias("kinds"))
    key = [sizes[p].eqNullSafe(kinds[p]) for p in parts]
    return sizes.join(kinds, key).select(*[sizes[p] for p in parts], "n_docs", "n_tokens", "longest", "lengths", "kinds")


def merge_sketches(sketches: DataFrame, group: str) -> DataFrame:
    """The columns of ``length_stats`` from stored sketches: counts exact, the rest within the sketches' error."""
    return sketches.groupBy(group).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.max("longest").alias("longest"),
        F.kll_merge_agg_bigint("lengths").alias("l"), F.hll_union_agg("kinds").alias("k"),
    ).select(
        group, "n_docs", "n_tokens", "longest",
        F.kll_sketch_get_quantile_bigint("l", F.lit(0.5)).alias("p50"), F.kll_sketch_get_quantile_bigint("l", F.lit(0.9)).alias("p90"),
        F.hll_sketch_estimate("k").alias("n_distinct"),
    )
