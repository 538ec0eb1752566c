"""A corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All
but the last return the columns of ``docs``; ``run`` writes each result as Parquet to the shared
folder and reads it again for the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.columns import row_key
from chatweave.llm.decontaminate import drop_contaminated
from chatweave.llm.jaccard_join import near_duplicates
from chatweave.llm.language_id import fit_text_model, identify
from chatweave.llm.line_dedup import drop_repeated_lines
from chatweave.llm.packing import pack_documents
from chatweave.session import scratch_path


KEY = "key"  # what a stage decides on: rows share it only if all that the decision reads is equal


def _keyed(docs: DataFrame, *read: str, by: list[str] | None = None) -> DataFrame:
    """The whole row, its key and the columns that the stage reads; no column of ``docs`` can clash."""
    return docs.select(F.struct("*").alias("row"), row_key("doc_id", *(by or read)).alias(KEY), *read)


def _without(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """``keyed`` without ``rows``, by their key; other rows of the same id stay."""
    gone = rows.select(F.col(KEY).alias("gone")).distinct()
    return keyed.join(gone, F.col(KEY) == F.col("gone"), "left_anti").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; blank ones and unknown scripts go."""
    model = fit_text_model(docs, "lang", "text")
    keyed = _keyed(docs, "text", "lang", "source", by=["doc_id", "text", "lang", "source"])
    judged = identify(keyed, model, KEY, declared=F.col("lang"), host=F.col("source"))
    return _without(keyed, judged.filter(~F.col("kept")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three documents share, and their new lengths."""
    kept = drop_repeated_lines(docs)
    return kept.select(*[
        F.col("_kept").alias(c) if c == "text" else F.length("_kept").cast("bigint").alias(c) if c == "n_chars"
        else F.col(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least id, null ids last. Of rows
    that are equal in all columns one stays; rows without words are in no group."""
    keyed = _keyed(docs, "text", by=docs.columns)
    told = near_duplicates(keyed, KEY).groupBy(KEY).agg(
        F.bool_or(F.col(KEY) != F.col("component_id")).alias("drop"),
        ((F.max("n_shingles") > 0) & (F.count(F.lit(1)) > 1)).alias("repeats"))
    path = scratch_path(spark, "near-rows")
    told.filter(F.col("drop") | F.col("repeats")).write.parquet(path)
    told = spark.read.parquet(path)
    repeated = told.filter(~F.col("drop")).select(F.col(KEY).alias("kept"))
    once = keyed.join(repeated, F.col(KEY) == F.col("kept"), "left_semi").dropDuplicates([KEY]).select("row.*")
    return _without(keyed, told).unionByName(once)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return drop_contaminated(docs, items)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 4096."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("line dedup", lines), ("n-gram Jaccard join", near),
          ("benchmark decontamination", benchmark), ("best-fit packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
