"""Memory telemetry over event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.sources.telemetry import parse_memory_lines


def memory_peaks(lines: DataFrame, window: str = "1 hour", delay: str | None = "10 minutes") -> DataFrame:
    """Peak and last use per window, rank, label and device.

    The log lines carry no time, so event time is the ingest time. On a stream, rows
    later than ``delay`` are dropped; a batch table needs no watermark.
    """
    parsed = parse_memory_lines(lines)
    if delay:
        parsed = parsed.withWatermark("ingest_ts", delay)
    peaks = parsed.groupBy(F.window("ingest_ts", window), "rank", "label", "device").agg(
        F.max("used_mb").alias("peak_mb"),
        F.max_by("used_mb", F.struct("ingest_ts", "used_mb")).alias("last_mb"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return peaks.select(
        F.col("window.start").alias("window_start"), "rank", "label", "device", "peak_mb", "last_mb",
        "n_lines",
    )
