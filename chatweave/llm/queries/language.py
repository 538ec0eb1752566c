"""Queries of language ID: documents by declared language and source, pages by markup and address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.language_id import fit_text_model, identify, page_host, page_language, page_text


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = fit_text_model(docs, "lang", "text")
    return identify(docs, model, declared=F.col("lang"), host=F.col("source"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, with text models from the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", page_text(F.col("html")).alias("text"), page_language(F.col("html")).alias("markup"),
        page_host(F.col("url")).alias("host"))
    return identify(pages, fit_text_model(docs, "lang", "text"), "page_id",
                    declared=F.col("markup"), host=F.col("host"))


QUERIES = {"op9_language_id": op9_language_id, "page_languages": page_languages}
ORACLE: dict[str, str] = {}
