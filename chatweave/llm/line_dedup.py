"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z in lower
case. Keys of at least ``min_chars`` code points that occur in at least ``min_docs``
documents keep their lines only in the document with the largest id.

Defined cases: null text is the empty text, one empty line. Rows that repeat an id are
documents of their own, counted each; all rows with the largest id keep their lines. A
null id is below every other. An empty table gives an empty table. Other columns of the
input pass through, whatever their names; columns named like the results give way to them.

How it runs: the hashes of all long lines are counted once, and only rows of repeated
keys go on, as (key, id) without text. They are taken in ``batches`` of falling ids. Each
batch is anti-joined with the runs of earlier batches: what is left are keys whose
largest id lies in this batch, and these are written as a new sorted run. ``fanout`` runs
of one level are compacted into one of the next. Runs are bucketed and sorted by key,
hence the anti-join of a batch reads them without a shuffle. Texts are shuffled
once, to meet the list of their dropped keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.columns import SPACE, lower_ascii
from chatweave.session import scratch_path

KEY = ["h", "k"]


def line_keys(text: Column, min_chars: int) -> Column:
    """One entry per line: the two hashes of its key, null for short keys.

    96 bits in all, so that different lines of even a very large corpus stay apart.
    """
    keys = F.transform(F.split(lower_ascii(text), "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)))
    return F.transform(keys, lambda x: F.when(
        F.length(x) >= min_chars, F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("k"))))


class Runs:
    """Sorted runs of keys on levels, in the shared folder; keys of all runs differ."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        # Runs hold repeated keys only, a small part of what a shuffle holds.
        self.buckets = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.path = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{self.made}"
        (rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", f"{self.path}/{self.made}").option("compression", "none").saveAsTable(table))
        self.made += 1
        return table

    def add(self, batch: DataFrame) -> None:
        """Add the keys of ``batch`` (h, k, top) that no run holds yet."""
        fresh = (batch.groupBy(*KEY).agg(F.max("top").alias("top"))
                 .repartition(self.buckets, *KEY))
        for table in sum(self.levels, []):
            fresh = fresh.join(self.spark.table(table), KEY, "left_anti")
        self._place(self._write(fresh), 0)

    def _place(self, table: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        runs = self.levels[level]
        runs.append(table)
        if len(runs) == self.fanout:
            merged = self._write(self._union(runs))
            for old in runs:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._place(merged, level + 1)

    def _union(self, tables: list[str]) -> DataFrame:
        out = self.spark.table(tables[0])
        for table in tables[1:]:
            out = out.unionByName(self.spark.table(table))
        return out

    def rows(self) -> DataFrame:
        """All keys with the id that holds them, read from the folder and not through the catalog."""
        tables = sum(self.levels, [])
        paths = [f"{self.path}/{t.rsplit('_', 1)[1]}" for t in tables]
        return self.spark.read.schema(self.spark.table(tables[0]).schema).parquet(*paths)

    def __enter__(self) -> Runs:
        return self

    def __exit__(self, *failure) -> None:
        """The tables leave the catalog, also after a failure; their files stay in the folder."""
        for number in range(self.made + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{number}")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                        min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                        fanout: int = 2) -> DataFrame:
    """``docs`` with ``_kept`` (the text without dropped lines), ``_n_lines`` and ``_n_dropped``."""
    spark, docs = docs.sparkSession, docs.drop("_kept", "_n_lines", "_n_dropped")
    rows = docs.select(F.col(id_col).alias("top"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    lines = rows.select("top", F.explode(F.array_compact(F.array_distinct(
        line_keys(F.col("t"), min_chars)))).alias("line")).select("top", "line.h", "line.k")
    often = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)

    cuts = rows.agg(F.percentile_approx(
        "top", [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] or []
    batch = F.lit(0)
    for cut in sorted(set(cuts)):
        batch = batch + F.when(F.col("top") <= F.lit(cut), 1).otherwise(0)
    batch = F.when(F.col("top").isNull(), F.lit(len(set(cuts)))).otherwise(batch)
    repeated = scratch_path(spark, "repeated-lines")
    (lines.join(often.select(*KEY), KEY, "left_semi").withColumn("batch", batch)
     .write.option("compression", "none").parquet(repeated))
    found = spark.read.schema("h bigint, k int, top {0}, batch int".format(
        dict(rows.dtypes)["top"])).parquet(repeated)

    with Runs(spark, fanout) as runs:
        for b in range(len(set(cuts)) + 1):
            runs.add(found.filter(F.col("batch") == b))
        holders = runs.rows().withColumnRenamed("top", "holder")
    gone = (found.join(holders, KEY).filter(~F.col("top").eqNullSafe(F.col("holder")))
            .groupBy("top").agg(F.collect_set(F.struct(*KEY)).alias("_gone"))
            .withColumnRenamed("top", "_holder_id"))

    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    parts = F.split("_text", "\n", -1)
    kept = F.transform(
        F.filter(F.arrays_zip(parts.alias("line"), line_keys(F.col("_text"), min_chars).alias("key")),
                 lambda x: x["key"].isNull() | ~F.array_contains(F.col("_gone"), x["key"])),
        lambda x: x["line"])
    cut = (packed.join(gone, F.col("_id").eqNullSafe(F.col("_holder_id")), "left")
           .withColumn("_rest", F.when(F.col("_gone").isNotNull(), kept)))
    return cut.select(
        "row.*",
        F.coalesce(F.array_join("_rest", "\n"), F.col("_text")).alias("_kept"),
        F.size(parts).cast("bigint").alias("_n_lines"),
        F.coalesce(F.size(parts) - F.when(F.col("_rest").isNotNull(), F.size("_rest")), F.lit(0))
        .cast("bigint").alias("_n_dropped"))
