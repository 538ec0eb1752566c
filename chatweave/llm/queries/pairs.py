"""Query of the near-duplicate join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatweave.llm.jaccard_join import near_duplicates


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op5_ngram_jaccard_join": op5_ngram_jaccard_join}
ORACLE: dict[str, str] = {}
