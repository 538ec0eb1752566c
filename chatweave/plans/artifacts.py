"""Artifact reports: configs, required files, sizes and cards of adapter folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.operators.inventory import REQUIRED_FILES, artifact_sizes, card_text, config_defaults, missing_files


def artifact_report(listing: DataFrame, configs: DataFrame) -> DataFrame:
    """One row per artifact of either input: config fields, file count, size, missing files
    and card.

    Both inputs are reduced to one row per artifact before they meet.
    """
    described = config_defaults(configs).select(
        "artifact", "base_model", "lora_r", F.col("lora_alpha_text").alias("lora_alpha"), "modules",
        card_text().alias("card"),
    )
    return (
        artifact_sizes(listing)
        .join(missing_files(listing), "artifact", "left")
        .join(described, "artifact", "full")
        .withColumn("n_files", F.coalesce("n_files", F.lit(0)))
        .withColumn("missing", F.coalesce("missing", F.array(*[F.lit(r) for r in REQUIRED_FILES])))
        .withColumn("ready", F.size("missing") == 0)
    )
