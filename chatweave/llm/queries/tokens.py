"""Queries of the operators that need a tokenizer file."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.lattice_score import score_documents
from chatweave.llm.packing import pack_documents
from chatweave.llm.token_count import count_tokens


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing, "op4_token_counts": op4_token_counts,
           "op6_lm_scoring": op6_lm_scoring}
ORACLE: dict[str, str] = {}
