"""Batched maps and batch inference."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.operators.inference import GenerationOptions, batched_map
from chatweave.plans.generation import answer_prompts

Spark = SparkSession


def _echo_factory():
    """A stand-in model: answers with the reversed prompt and fails on long ones."""

    def model(prompts: list[str], max_new_tokens: int, **_) -> list[str]:
        if any(len(p) > 900 for p in prompts):
            raise ValueError("prompt too long")
        return [p[:max_new_tokens][::-1] for p in prompts]

    return model


@query("batch_infer", """
WITH p AS (
  SELECT conv_id, turn, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
    || '<|im_start|>assistant' || chr(10) AS t
  FROM conversations WHERE role = 'user')
SELECT conv_id, turn, CASE WHEN length(t) <= 900 THEN md5(reverse(substr(t, 1, 200))) END AS response_md5,
  CASE WHEN length(t) > 900 THEN 'ValueError: prompt too long' END AS error
FROM p
""")
def batch_infer(spark: Spark, folder: str) -> DataFrame:
    prompts = d.conversations(spark, folder).filter(F.col("role") == "user").select("conv_id", "turn", "text")
    named = prompts.withColumnRenamed("text", "prompt")
    rows = answer_prompts(named, _echo_factory, options=GenerationOptions(max_new_tokens=200), batch_size=32)
    return rows.select("conv_id", "turn", F.md5("response").alias("response_md5"), "error")


def _measure(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": batch["doc_id"], "n_words": batch["text"].str.count(r"[^ \n]+")})


@query("batched_map", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \n]+')) AS BIGINT) AS n_words FROM documents
""")
def mapped(spark: Spark, folder: str) -> DataFrame:
    docs = d.documents(spark, folder).select("doc_id", "text")
    return batched_map(docs, _measure, "doc_id bigint, n_words bigint", batch_size=64)
