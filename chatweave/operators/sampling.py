"""Selection among scored candidates: rows ``(group_id, cand, score)``.

Candidates are ordered from the highest score down, then by the smaller id. NaN counts as the
highest number, as everywhere in Spark; null scores come last. Rows with a null group are
one group. The order is the same for every ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.operators.joins import join_null_safe
from chatweave.operators.ordered import CHUNK, Running, range_chunks, running

# The default sampling settings.
TEMPERATURE = 0.7
TOP_K = 50
TOP_P = 0.9

# Up to this k Spark cuts groups down before the shuffle (its window group limit).
GROUP_LIMIT = 1_000


def _best_first() -> list[Column]:
    return [F.desc_nulls_last("score"), F.col("cand").asc()]


def _ranks_in_chunks(cands: DataFrame, partitions: int | None) -> DataFrame:
    """Rank from the best candidate down, for groups of any size."""
    chunked = range_chunks(cands, ["group_id", *_best_first()], partitions)
    rank = {"rank": Running("sum", F.lit(1).cast("long"))}
    return running(chunked, ["group_id"], _best_first(), rank).drop(CHUNK)


def top_k(cands: DataFrame, k: int = TOP_K, partitions: int | None = None) -> DataFrame:
    """The ``k`` best candidates per group; ties go to the smaller candidate id.

    For a small k each map task keeps its own k best first, so large groups shrink
    before the shuffle. For a large one, groups are split into range chunks.
    """
    if k > GROUP_LIMIT:
        ranked = _ranks_in_chunks(cands, partitions).withColumn("rank", F.col("rank").cast("int"))
    else:
        best = Window.partitionBy("group_id").orderBy(*_best_first())
        ranked = cands.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k)


def _nucleus_of_top_k(cands: DataFrame, k: int) -> DataFrame:
    """Nucleus over at most ``k`` rows per group."""
    group = Window.partitionBy("group_id")
    best = group.orderBy(*_best_first())
    weighted = top_k(cands, k).withColumn("w", F.exp(F.col("score") - F.max("score").over(group)))
    total = F.sum("w").over(group)
    mass = F.coalesce(F.sum("w").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return weighted.withColumn("prob", F.col("w") / total).withColumn("before", mass / total)


def _nucleus_of_all(cands: DataFrame, partitions: int | None) -> DataFrame:
    """Nucleus over groups of any size.

    Groups are split into range chunks first; every join after that is on (group,
    chunk), so no step gathers a large group.
    """
    key, order = ["group_id", CHUNK], _best_first()
    chunked = range_chunks(cands, ["group_id", *order], partitions)
    tops = chunked.groupBy(*key).agg(F.max("score").alias("top"))
    peaks = tops.select(*key, F.max("top").over(Window.partitionBy("group_id")).alias("peak"))
    weighted = join_null_safe(chunked, peaks, key, "inner").withColumn("w", F.exp(F.col("score") - F.col("peak")))
    values = {
        "mass": Running("sum", F.col("w"), inclusive=False),
        "rank": Running("sum", F.lit(1).cast("long")),
    }
    summed = running(weighted, ["group_id"], order, values, totals=["mass"])
    total = F.col("mass_total")
    return summed.select(
        "group_id", "cand", "score", "rank", (F.col("w") / total).alias("prob"),
        (F.col("mass") / total).alias("before"),
    )


def nucleus(
    cands: DataFrame, temperature: float = TEMPERATURE, k: int | None = TOP_K, p: float = TOP_P,
    partitions: int | None = None,
) -> DataFrame:
    """The smallest prefix of candidates by probability whose mass reaches ``p``.

    Temperature and top-k come first; the best candidate always stays. ``k=None``
    switches top-k off.
    """
    heated = cands.withColumn("score", F.col("score").cast("double") / F.lit(temperature))
    if k is not None and k > GROUP_LIMIT:
        heated, k = top_k(heated, k, partitions).drop("rank"), None
    probs = _nucleus_of_all(heated, partitions) if k is None else _nucleus_of_top_k(heated, k)
    return probs.filter((F.col("before") < p) | (F.col("rank") == 1)).select(
        "group_id", "cand", "score", "prob"
    )


def greedy(cands: DataFrame) -> DataFrame:
    """The best candidate per group; ties go to the smaller id."""
    return cands.groupBy("group_id").agg(
        F.max_by("cand", F.struct("score", -F.col("cand"))).alias("cand")
    )


def seeded_uniform(seed: int, *keys: str) -> Column:
    """A number strictly between 0 and 1 from a digest of the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)


def weighted_pick(
    cands: DataFrame, seed: int, temperature: float = TEMPERATURE, k: int | None = TOP_K,
    p: float = TOP_P, partitions: int | None = None,
) -> DataFrame:
    """One seeded draw per group from the nucleus; temperature 0 is greedy.

    The draw is the largest log-probability plus Gumbel noise, a plain aggregate
    that combines on the map side and repeats exactly for a seed.
    """
    if temperature == 0:
        return greedy(cands)
    kept = nucleus(cands, temperature, k, p, partitions)
    noise = -F.log(-F.log(seeded_uniform(seed, "group_id", "cand")))
    noisy = kept.withColumn("g", F.log("prob") + noise)
    return noisy.groupBy("group_id").agg(
        F.max_by("cand", F.struct("g", -F.col("cand"))).alias("cand")
    )
