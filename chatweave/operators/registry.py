"""Model registry lookups and rules that depend on a model name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.operators.joins import bounded_broadcast

# Model keys, their ids and the two default keys.
MODELS = {
    "14b": "Qwen/Qwen2.5-Coder-14B-Instruct",
    "32b": "Qwen/Qwen2.5-Coder-32B-Instruct",
}
TRAIN_DEFAULT = "32b"
PREPARE_DEFAULT = "14b"

# Rows per device for the large and for other models.
LARGE_MARK = "32b"
LARGE_BATCH = 56
OTHER_BATCH = 72

# Rows per device, accumulation steps and longest sequence, for large models and for others.
RULES = {"large": (LARGE_BATCH, 1, 1024), "other": (OTHER_BATCH, 1, 1024)}


def registry_table(spark: SparkSession, models: dict[str, str] | None = None) -> DataFrame:
    rows = list((models or MODELS).items())
    return spark.createDataFrame(rows, "key string, model string")


def lookup_model(df: DataFrame, key: str, registry: DataFrame, default: str) -> DataFrame:
    """Add ``model``; an unknown key gets the model of the ``default`` key."""
    fallback = registry.filter(F.col("key") == default).first()
    if fallback is None:
        raise KeyError(default)
    table = bounded_broadcast(registry.withColumnRenamed("key", key))
    return df.join(table, key, "left").withColumn(
        "model", F.coalesce("model", F.lit(fallback["model"]))
    )


def training_rule(model: Column | str, rules: dict[str, tuple[int, int, int]] | None = None) -> Column:
    """A struct of the training settings that follow from a model's name: ``rows``, ``accumulation``, ``max_length``."""
    model = F.col(model) if isinstance(model, str) else model
    rules = rules or RULES

    def row(kind: str) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(("rows", "accumulation", "max_length"), rules[kind], strict=True)])

    return F.when(F.lower(model).contains(LARGE_MARK), row("large")).otherwise(row("other"))


def rows_per_device(model: Column | str) -> Column:
    model = F.col(model) if isinstance(model, str) else model
    return F.when(F.lower(model).contains(LARGE_MARK), LARGE_BATCH).otherwise(OTHER_BATCH)


def pair_adapters(adapters: DataFrame, bases: DataFrame, given: str | None = None) -> DataFrame:
    """Adapter rows with the base model their config names.

    ``given`` is used for adapters whose config names none; the config wins.
    """
    name = F.col("base_model_name_or_path")
    wanted = adapters.withColumn("base_model", F.coalesce(name, F.lit(given)) if given else name)
    return wanted.join(bases, "base_model", "left")
