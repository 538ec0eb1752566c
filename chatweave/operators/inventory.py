"""Artifact listings, required files and text cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatweave.functions.text import gibibytes, join_list, mebibytes

# Files an adapter must have, in report order.
REQUIRED_FILES = ("adapter_config.json", "adapter_model.safetensors")

# Names of parts that Spark writes: number, id of the write, number of the file within the task, ending.
PART_NAME = r"^part-[0-9]+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})(?:[.-]c[0-9]+)?([.].*)?$"

# Defaults where a config leaves a field out.
UNKNOWN = "unknown"
DEFAULT_BASE_MODEL = "Qwen/Qwen2.5-Coder-32B-Instruct"
DEFAULT_RANK = 64
DEFAULT_ALPHA = 128


def file_sizes(listing: DataFrame) -> DataFrame:
    """Files with their size in MB, in the order of artifact and name."""
    return listing.withColumn("size_mb", mebibytes("length")).orderBy("artifact", "name")


def whole_files(listing: DataFrame, artifact: str = "artifact") -> DataFrame:
    """A listing in which the parts that one write left in a folder are one file.

    Parts are named ``part-<number>-<id of the write>.<rest>``; their file has the name without
    the number, and the lengths of its parts. Other files stay as they are.
    """
    whole = F.regexp_replace("name", PART_NAME, "part-$1$2")
    parted = F.col("name").rlike(PART_NAME)
    parts = listing.filter(parted).groupBy(artifact, whole.alias("name")).agg(F.sum("length").alias("length"))
    # A folder without files has a null name.
    rest = listing.filter(~F.coalesce(parted, F.lit(False))).select(artifact, "name", "length")
    return parts.unionByName(rest)


def artifact_sizes(listing: DataFrame, artifact: str = "artifact") -> DataFrame:
    return listing.groupBy(artifact).agg(
        F.count("name").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    ).withColumn("total_gb", gibibytes("total_bytes"))


def missing_files(
    listing: DataFrame, artifact: str = "artifact", name: str = "name",
    required: Sequence[str] = REQUIRED_FILES,
) -> DataFrame:
    """Required names each artifact lacks, in the required order.

    Only required names are collected, so a group holds at most that many values
    however many files an artifact has. An artifact without files is a row with a
    null name.
    """
    wanted = F.array(*[F.lit(r) for r in required])
    present = F.collect_set(F.when(F.col(name).isin(*required), F.col(name)))
    return listing.groupBy(artifact).agg(F.array_except(wanted, present).alias("missing"))


def config_defaults(
    configs: DataFrame, base: str = UNKNOWN, rank: int | str = UNKNOWN, alpha: int | str = UNKNOWN
) -> DataFrame:
    """Fill the fields a config leaves out."""
    return (
        configs.withColumn("base_model", F.coalesce("base_model_name_or_path", F.lit(base)))
        .withColumn("lora_r", F.coalesce(F.col("r").cast("string"), F.lit(str(rank))))
        .withColumn("lora_alpha_text", F.coalesce(F.col("lora_alpha").cast("string"), F.lit(str(alpha))))
        .withColumn("modules", join_list("target_modules"))
    )


def card_text(
    training_steps: str = "2038", license: str = "apache-2.0", tags: Sequence[str] = ("fine-tuned", "lora"),
    library: str = "peft",
) -> Column:
    """A Markdown card of one configured artifact (after ``config_defaults``): a metadata
    block and a table of the training details."""
    base = F.col("base_model")
    lines = ["---", f"license: {license}", F.concat(F.lit("base_model: "), base), "tags:", *[f"- {t}" for t in tags],
             f"library_name: {library}", "pipeline_tag: text-generation", "---", "",
             F.concat(F.lit("# Adapter for "), base), "", "| Field | Value |", "| --- | --- |"]
    fields = {"Base model": base, "Rank (r)": F.col("lora_r"), "Alpha": F.col("lora_alpha_text"),
              "Target modules": F.col("modules"), "Training steps": F.lit(training_steps)}
    lines += [F.concat(F.lit(f"| {name} | "), F.coalesce(value, F.lit("null")), F.lit(" |")) for name, value in fields.items()]
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def device_memory(devices: Column | str = "devices") -> Column:
    """Total memory of a nested device list."""
    devices = F.col(devices) if isinstance(devices, str) else devices
    return F.aggregate(devices, F.lit(0.0), lambda a, d: a + d["total_memory_gb"])
