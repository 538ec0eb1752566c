"""Memory telemetry: log lines, meminfo lines and device CSV lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The log line format.
MEMORY_LINE = r"^\[Rank (\d+)\] \[MEM:([^\]]*)\] (RAM|GPU\d+): ([\d,]+)MB / ([\d,]+)MB"


def _group(line: Column, i: int) -> Column:
    return F.regexp_extract(line, MEMORY_LINE, i)


def _number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def parse_memory_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Memory lines to (rank, label, device, used_mb, total_mb); other lines are not
    memory lines and are left out."""
    c = F.col(line)
    return lines.filter(c.rlike(MEMORY_LINE)).select(
        *[x for x in lines.columns if x != line],
        _group(c, 1).cast("int").alias("rank"),
        _group(c, 2).alias("label"),
        _group(c, 3).alias("device"),
        _number(_group(c, 4)).alias("used_mb"),
        _number(_group(c, 5)).alias("total_mb"),
    )


# Device files: index, used and total MB; a line that is something else is kept whole in the last column.
DEVICE_FIELDS = "device int, used_mb bigint, total_mb bigint"
BROKEN = "broken_line"


def read_lines(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int = 1000,
               names: str | None = None) -> DataFrame:
    """Text files, also in subfolders, as lines (ingest_ts, file, line).

    The lines carry no time, so that of their file counts: when it was last written. On a
    stream, files that are added later are read by later micro-batches; a file counts as
    it is when it is first seen, so writers add files and leave finished ones alone. ``names`` is a pattern for
    the names of the files, such as ``*.log``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    reader = reader.option("recursiveFileLookup", "true")
    if names:
        reader = reader.option("pathGlobFilter", names)
    return reader.text(path).select(
        F.col("_metadata.file_modification_time").alias("ingest_ts"), F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("line"))


def read_device_lines(lines: DataFrame, line: str = "line", fields: str = DEVICE_FIELDS) -> DataFrame:
    """Lines of comma-separated fields as columns; a line with other fields has null fields and
    is kept in ``broken_line``. Blank lines are left out."""
    read = F.from_csv(F.col(line), f"{fields}, {BROKEN} string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    rows = lines.filter(F.trim(line) != "").select(*[x for x in lines.columns if x != line], F.col(line).alias("_line"), read.alias("_r"))
    # A broken line may still have filled some fields.
    good = F.col(f"_r.{BROKEN}").isNull() & (F.size(F.split("_line", ",")) == len(fields.split(",")))
    names = [f.split()[0] for f in fields.split(",")]
    return rows.select(*[x for x in lines.columns if x != line], *[F.when(good, F.col(f"_r.{n}")).alias(n) for n in names],
                       F.when(~good, F.col("_line")).alias(BROKEN))


def parse_device_csv(lines: DataFrame, line: str = "line") -> DataFrame:
    """CSV lines with exactly three fields; others are left out."""
    parts = F.split(line, ", ")
    return lines.filter(F.size(parts) == 3).select(
        *[x for x in lines.columns if x != line],
        F.element_at(parts, 1).try_cast("int").alias("device"),
        F.element_at(parts, 2).try_cast("bigint").alias("used_mb"),
        F.element_at(parts, 3).try_cast("bigint").alias("total_mb"),
    )


def host_memory(lines: DataFrame, host: str = "host", number: str = "line_no", line: str = "line") -> DataFrame:
    """Total, used MB and used percent per host from meminfo lines.

    The first matching line wins; kB become MB by integer division first.
    """
    c = F.col(line)
    kb = F.element_at(F.split(F.trim(c), r"\s+"), 2).try_cast("bigint")

    def first_mb(mark: str) -> Column:
        # Two steps: the first line that matches, then its value.
        return F.min_by(kb, F.when(c.contains(mark), F.col(number)))

    found = lines.filter(c.contains("MemTotal") | c.contains("MemAvailable")).groupBy(host).agg(
        first_mb("MemTotal").alias("total_kb"), first_mb("MemAvailable").alias("available_kb")
    )
    mb = found.select(
        host,
        F.expr("total_kb div 1024").alias("total_mb"),
        F.expr("available_kb div 1024").alias("available_mb"),
    )
    used = F.col("total_mb") - F.col("available_mb")
    return mb.select(
        host, "total_mb", used.alias("used_mb"),
        (F.lit(100) * used / F.col("total_mb")).alias("used_percent"),
    )
