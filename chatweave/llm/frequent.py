"""The most frequent rows of a count table, for shipping to all workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def most_frequent(table: DataFrame, count: str, limit: int) -> list[Row]:
    """At most ``limit`` rows, those of the highest counts.

    Counts are grouped by the eighth part of a power of two; whole groups are taken from the
    top while they fit. Only group sizes and the rows taken reach the driver, whatever the
    number of partitions.
    """
    group = F.floor(F.log2(F.col(count)) * 8).cast("int")
    sizes = table.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["g"]):
        if taken + r["n"] > limit:
            break
        taken, least = taken + r["n"], r["g"]
    return [] if least is None else table.filter(group >= least).collect()
