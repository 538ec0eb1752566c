"""Queries of the operators that look at each text: fingerprints and secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm import fingerprint, secrets


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = fingerprint.with_next(docs, "doc_id", ["text", "_sketch"], fingerprint.fingerprints)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - half), F.substring(F.col("_next.text"), F.lit(1), half)))
    done = edited.withColumn("_edited", fingerprint.sketch(F.col("edited")))
    return done.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("_sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("_edited")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("_sketch"), F.col("_edited")).alias("near_edited"),
        fingerprint.likeness(F.col("_sketch"), F.col("_next._sketch")).alias("near_next"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = secrets.scan_secrets(docs)
    return found.select(
        "doc_id", *[secrets.count_kind(F.col("_base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        secrets.count_kind(F.col("_all"), "entropy").alias("n_entropy"),
        F.sha2(secrets.as_text(F.col("_base")), 256).alias("base_sha256"),
        secrets.as_text(F.col("_all")).alias("spans"))


QUERIES = {"op1_fingerprints": op1_fingerprints, "op2_secret_scans": op2_secret_scans}
ORACLE: dict[str, str] = {}
