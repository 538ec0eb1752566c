"""Rows, seconds and rates of jobs that run or have run."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatweave.functions.numbers import whole_div
from chatweave.sources.tables import write_columns

WRITTEN = "sink string, source string, n_rows bigint, seconds double, rows_per_second double"
BATCHES = "name string, batch bigint, source string, n_rows bigint, seconds double, rows_per_second double"


def _rate(rows: int, seconds: float) -> float | None:
    return rows / seconds if seconds > 0 else None


def write_all(spark: SparkSession, sinks: Mapping[str, tuple[DataFrame, str]], by: str | None = None,
              sources: tuple = (), mode: str = "errorifexists") -> DataFrame:
    """Write several datasets, (rows, path) by name, and tell the rows, seconds and rate of each.

    Rows are counted by a named observation of the job that writes them, so nothing is read again.
    With ``by``, a column that holds one of ``sources``, each source is counted too; rows of none of them
    count in the total only, which has a null source.
    """
    told = []
    for name, (df, path) in sinks.items():
        seen = Observation(f"written {name}")
        counts = [F.count(F.lit(1)).alias("total"),
                  *(F.count_if(F.col(by).eqNullSafe(F.lit(s))).alias(f"source{i}") for i, s in enumerate(sources if by else ()))]
        counted = df.observe(seen, *counts)
        started = time.monotonic()
        write_columns(counted, path, mode)
        seconds = time.monotonic() - started
        found = seen.get
        told.append((name, None, found["total"], seconds, _rate(found["total"], seconds)))
        told += [(name, str(s), found[f"source{i}"], seconds, _rate(found[f"source{i}"], seconds))
                 for i, s in enumerate(sources if by else ())]
    return spark.createDataFrame(told, WRITTEN)


def stream_progress(spark: SparkSession, running: StreamingQuery) -> DataFrame:
    """The micro-batches of a query, running or ended, that Spark still knows
    (``spark.sql.streaming.numRecentProgressUpdates``, the last 100 unless set), one row per batch and source."""
    rows = []
    for batch in running.recentProgress:
        seconds = batch["batchDuration"] / 1000
        for source in batch["sources"]:
            n = source["numInputRows"]
            rows.append((batch["name"], batch["batchId"], source["description"], n, seconds, _rate(n, seconds)))
    return spark.createDataFrame(rows, BATCHES)


def remaining_seconds(total: int, done: DataFrame) -> DataFrame:
    """Per name the rows so far, those left of ``total`` and the seconds these take at the rate so far."""
    summed = done.groupBy("name").agg(F.sum("n_rows").alias("n_rows"), F.sum("seconds").alias("seconds"))
    left = F.greatest(F.lit(total) - F.col("n_rows"), F.lit(0))
    return summed.select("name", "n_rows", left.alias("left"), whole_div(F.lit(100) * F.col("n_rows"), F.greatest(F.lit(total), F.lit(1))).alias("percent"),
                         F.when(F.col("n_rows") > 0, left * F.col("seconds") / F.col("n_rows")).alias("seconds_left"))
