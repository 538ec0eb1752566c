"""Prompt tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from chatweave.schemas import PROMPTS


def prompt_table(spark: SparkSession, prompts: Sequence[dict | tuple | str], max_new_tokens: int = 512) -> DataFrame:
    """Prompts written as strings, (name, prompt) pairs or dicts, numbered from 1."""
    rows = []
    for i, p in enumerate(prompts, 1):
        if isinstance(p, str):
            p = {"prompt": p}
        elif isinstance(p, tuple):
            p = {"name": p[0], "prompt": p[1]}
        rows.append((i, p.get("name"), p.get("system"), p["prompt"], p.get("max_new_tokens", max_new_tokens)))
    return spark.createDataFrame(rows, PROMPTS)
