"""File-source streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatweave.schemas import SESSION_INPUT, TELEMETRY_LINES, TOKEN_STREAM


def _stream(spark: SparkSession, path: str, schema: str, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def session_inputs(spark: SparkSession, path: str, files_per_batch: int = 1000, at: str | None = None) -> DataFrame:
    """Session inputs, with a time column if ``at`` names one."""
    return _stream(spark, path, f"{SESSION_INPUT}, {at} timestamp" if at else SESSION_INPUT, files_per_batch)


def token_rows(spark: SparkSession, path: str, files_per_batch: int = 1000, id_type: str = "bigint",
               at: str | None = None) -> DataFrame:
    """Token rows, with a time column if ``at`` names one."""
    schema = TOKEN_STREAM.replace("id bigint", f"id {id_type}", 1)
    return _stream(spark, path, f"{schema}, {at} timestamp" if at else schema, files_per_batch)


def telemetry_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return _stream(spark, path, TELEMETRY_LINES, files_per_batch)
