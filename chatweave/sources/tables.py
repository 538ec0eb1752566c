"""Tables, columnar datasets and JSON-lines files."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.operators.joins import bounded_broadcast
from chatweave.operators.ordered import byte_shards, head_slice
from chatweave.schemas import CHAT_ROWS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_prefix(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a source in its key order."""
    return head_slice(df, keys, n)


def read_in_storage_order(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """A parquet dataset with ``row_ord``, the position of each row in storage order
    (files by name, rows as stored), or only its first ``n`` rows.

    Nothing is sorted or shuffled: rows know their place in their file, and files are
    counted from their footers. With ``n``, files behind the last one needed are left out
    of the scan.
    """
    rows = spark.read.parquet(path)
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    # One row per file.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_file", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    if n is not None:
        ends = F.col("_offset") + F.col("_size")
        last = offsets.filter(ends >= n).agg(F.min("_file").alias("f")).first()["f"]
        if last is not None:
            placed = placed.filter(F.col("_file") <= last)
            offsets = offsets.filter(F.col("_file") <= last)
    found = placed.join(bounded_broadcast(offsets), "_file").withColumn(
        "row_ord", F.col("_offset") + F.col("_row")
    )
    if n is not None:
        found = found.filter(F.col("row_ord") < n)
    return found.select("row_ord", *rows.columns)


def write_jsonl(df: DataFrame, path: str, order: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """One ``{"messages": ...}`` object per line; null contents are written as null.

    With ``order`` the files hold consecutive key ranges, so reading them by name
    gives the rows in order.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    line = F.to_json(F.struct("messages"), {"ignoreNullFields": "false"})
    df.select(line.alias("value")).write.mode(mode).text(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = CHAT_ROWS) -> DataFrame:
    """Fixed schema; a malformed line stops the job instead of becoming a null row."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_columns(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_columns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fingerprint(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True).encode()).hexdigest()[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence in whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def require_path(spark: SparkSession, path: str) -> str:
    """Stop early if an input is missing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return path


def materialise(
    spark: SparkSession, path: str, params: dict, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read the dataset built earlier with the same parameters, or build it.

    Each parameter set has its own folder, and a folder counts only once its job
    has committed, so neither partial nor outdated data is reused.
    """
    target = f"{path.rstrip('/')}/{fingerprint(params)}"
    if not path_exists(spark, f"{target}/_SUCCESS"):
        write_columns(build(), target, mode="overwrite")
    return read_columns(spark, target)


def publish(df: DataFrame, path: str, revision: str | None = None) -> None:
    """Replace one revision of a published table, also by no rows, and leave the others alone.

    The revision's folder is overwritten by its path, with the table's own way of writing
    partition values.
    """
    name = re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", revision or "main")
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/revision={name}")


# Up to this many shards their first keys are part of the plan.
PLACED_SHARDS = 10_000
STRETCH = 100


def _place(key: Column, firsts: list) -> Column:
    """The number of the last of the ascending ``firsts`` that ``key`` reaches, 0 if it reaches none:
    by stretches first, then within one."""
    if len(firsts) < 2:
        return F.lit(0)
    ends = F.lit(firsts[::STRETCH])
    stretch = F.greatest(F.size(F.filter(ends, lambda x: x <= key)) - 1, F.lit(0))
    within = F.size(F.filter(F.slice(F.lit(firsts), stretch * STRETCH + 1, F.lit(STRETCH)), lambda x: x <= key))
    return F.coalesce(F.greatest(stretch * STRETCH + within - 1, F.lit(0)), F.lit(0))


def place_shards(df: DataFrame, key: str, content: str, cap: int, max_row_bytes: int = 0) -> DataFrame:
    """``df`` with ``shard``, one partition per shard, in key order.

    Only (key, size) rows are numbered; the first key of each shard then tells every wide row its
    partition, so wide rows are shuffled once and meet no join. Rows of equal keys share a shard; rows without
    a key go to the first one. Beyond ``PLACED_SHARDS`` shards the wide rows look up their number.
    """
    sizes = df.select(key, F.octet_length(content).cast("long").alias("_size"))
    shards = byte_shards(sizes, key, "_size", cap, max_row_bytes=max_row_bytes).filter(F.col(key).isNotNull())
    firsts = shards.groupBy("shard").agg(F.min(key).alias("first"))
    # A bounded list: one row more than fits tells that there are too many.
    found = firsts.orderBy("shard").limit(PLACED_SHARDS + 1).collect()
    if len(found) > PLACED_SHARDS:
        number = shards.groupBy(key).agg(F.max("shard").alias("shard"))
        joined = df.join(number, key, "left").withColumn("shard", F.coalesce("shard", F.lit(found[0]["shard"])))
        return joined.repartition("shard").sortWithinPartitions("shard", key)
    # Keys that straddle two shards are in both lists; the later shard has them.
    found = [r for r, after in zip(found, [*found[1:], None]) if after is None or r["first"] != after["first"]]
    place = _place(F.col(key), [r["first"] for r in found])
    number = F.get(F.lit([r["shard"] for r in found] or [0]), place).cast("bigint")
    placed = df.withColumn("shard", number).repartitionById(max(1, len(found)), place)
    return placed.sortWithinPartitions("shard", key)


def write_sharded(
    df: DataFrame, path: str, key: str, content: str, cap: int, max_row_bytes: int = 0,
    mode: str = "errorifexists",
) -> None:
    """Write one folder per shard of about ``cap`` content bytes, in key order."""
    place_shards(df, key, content, cap, max_row_bytes).write.mode(mode).partitionBy("shard").parquet(path)
