"""Registries, artifact tables and telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.numbers import whole_div
from chatweave.functions.text import base_name
from chatweave.operators import inventory as inv
from chatweave.operators import registry as reg
from chatweave.session import scratch_path
from chatweave.sources.artifacts import list_artifacts, read_configs, write_cards
from chatweave.sources.tables import read_table
from chatweave.sources.telemetry import host_memory, parse_device_csv, parse_memory_lines

Spark = SparkSession

_M14, _M32 = reg.MODELS["14b"], reg.MODELS["32b"]


@query("model_registry", f"""
WITH k AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '14b' WHEN 1 THEN '32b' WHEN 2 THEN '72b' END AS size FROM documents),
m AS (
  SELECT *, CASE size WHEN '14b' THEN '{_M14}' ELSE '{_M32}' END AS train_model,
    CASE size WHEN '32b' THEN '{_M32}' ELSE '{_M14}' END AS prepare_model FROM k)
SELECT doc_id, size, train_model, prepare_model, list_extract(string_split(train_model, '/'), -1) AS train_name,
  CASE WHEN lower(train_model) LIKE '%32b%' THEN 56 ELSE 72 END AS train_rows, 1 AS train_accumulation, 1024 AS train_length
FROM m
""")
def model_registry(spark: Spark, folder: str) -> DataFrame:
    rest = F.col("doc_id") % 4
    keys = d.documents(spark, folder).select(
        "doc_id", F.when(rest == 0, "14b").when(rest == 1, "32b").when(rest == 2, "72b").alias("size")
    )
    registry = reg.registry_table(spark)
    train = reg.lookup_model(keys, "size", registry, reg.TRAIN_DEFAULT).withColumnRenamed("model", "train_model")
    both = reg.lookup_model(train, "size", registry, reg.PREPARE_DEFAULT).withColumnRenamed("model", "prepare_model")
    return both.select(
        "doc_id", "size", "train_model", "prepare_model", base_name("train_model").alias("train_name"),
        reg.rows_per_device("train_model").alias("train_rows"),
        reg.training_rule("train_model")["accumulation"].alias("train_accumulation"),
        reg.training_rule("train_model")["max_length"].alias("train_length"),
    )


@query("missing_files", f"""
WITH {d.LISTING_SQL},
f AS (
  SELECT artifact, bool_or(name = 'adapter_config.json') AS c, bool_or(name = 'adapter_model.safetensors') AS m
  FROM listing GROUP BY artifact)
SELECT artifact, concat_ws(',', CASE WHEN NOT c THEN 'adapter_config.json' END,
  CASE WHEN NOT m THEN 'adapter_model.safetensors' END) AS missing
FROM f
""")
def missing_files(spark: Spark, folder: str) -> DataFrame:
    rows = inv.missing_files(d.listing(spark, folder))
    return rows.select("artifact", F.array_join("missing", ",").alias("missing"))


@query("artifact_sizes", f"""
WITH {d.LISTING_SQL}
SELECT artifact, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes,
  CAST(sum(length) AS DOUBLE) / 1073741824.0::DOUBLE AS total_gb
FROM listing GROUP BY artifact
""")
def artifact_sizes(spark: Spark, folder: str) -> DataFrame:
    return inv.artifact_sizes(d.listing(spark, folder))


@query("file_sizes", f"""
WITH {d.LISTING_SQL}
SELECT artifact, name, length, CAST(length AS DOUBLE) / 1048576.0::DOUBLE AS size_mb FROM listing
""")
def file_sizes(spark: Spark, folder: str) -> DataFrame:
    return inv.file_sizes(d.listing(spark, folder))


@query("artifact_scan", """
SELECT 'lang=' || lang AS artifact, 1::BIGINT AS n_files, 'text' AS kinds, CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes,
  CAST(sum(strlen(text) + 1) AS DOUBLE) / 1073741824.0::DOUBLE AS total_gb
FROM documents GROUP BY lang
""")
def artifact_scan(spark: Spark, folder: str) -> DataFrame:
    # One folder per language; each text is followed by a line end. Every task writes its rows where it read them.
    path = scratch_path(spark, "artifacts")
    texts = d.documents(spark, folder).select("lang", F.col("text").alias("value"))
    texts.write.partitionBy("lang").text(path)
    folders = d.documents(spark, folder).select(F.concat(F.lit(f"{path}/lang="), "lang").alias("path")).distinct()
    # Checksum files lie beside the files on some file systems.
    files = inv.whole_files(list_artifacts(spark, folders).filter(~F.col("name").startswith(".")))
    kinds = files.groupBy("artifact").agg(F.array_join(F.array_sort(F.collect_set(F.when(
        F.col("name").rlike("^part-.*[.]txt$"), "text").otherwise("other"))), ",").alias("kinds"))
    return inv.artifact_sizes(files).join(kinds, "artifact").select("artifact", "n_files", "kinds", "total_bytes", "total_gb")


# Adapter configs: one per document source and language, some fields left out.
CONFIGS_SQL = """
configs AS (
  SELECT source || '-' || lang AS artifact,
    CASE WHEN lang = 'en' THEN NULL ELSE 'base-' || lang END AS base,
    CASE WHEN lang = 'fr' THEN NULL ELSE count(*) END AS r,
    CASE WHEN lang = 'de' THEN NULL ELSE 2 * count(*) END AS alpha,
    CASE WHEN lang = 'es' THEN '' ELSE 'q_proj, ' || lang END AS modules
  FROM documents GROUP BY source, lang)
"""


def _configs(spark: Spark, folder: str) -> DataFrame:
    """Write the configs as JSON files, one folder per artifact, and scan them back."""
    lang = F.col("lang")
    made = d.documents(spark, folder).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws("-", "source", "lang").alias("artifact"),
        F.when(lang != "en", F.concat(F.lit("base-"), lang)).alias("base_model_name_or_path"),
        F.when(lang != "fr", F.col("n").cast("int")).alias("r"),
        F.when(lang != "de", (2 * F.col("n")).cast("int")).alias("lora_alpha"),
        F.when(lang != "es", F.array(F.lit("q_proj"), lang)).alias("target_modules"),
    )
    path = scratch_path(spark, "configs")
    fields = F.struct("base_model_name_or_path", "r", "lora_alpha", "target_modules")
    made.select("artifact", F.to_json(fields).alias("value")).repartition("artifact").write.partitionBy("artifact").text(path)
    found = read_configs(spark, f"{path}/*/")
    return found.withColumn("artifact", F.regexp_replace("artifact", "^artifact=", ""))


@query("config_scan", f"""
WITH {CONFIGS_SQL}
SELECT artifact, coalesce(base, 'unknown') AS base_model, coalesce(CAST(r AS VARCHAR), 'unknown') AS lora_r,
  coalesce(CAST(alpha AS VARCHAR), 'unknown') AS lora_alpha, modules
FROM configs
""")
def config_scan(spark: Spark, folder: str) -> DataFrame:
    rows = inv.config_defaults(_configs(spark, folder))
    return rows.select("artifact", "base_model", "lora_r", F.col("lora_alpha_text").alias("lora_alpha"), "modules")


@query("card_text", f"""
WITH {CONFIGS_SQL}
SELECT artifact, md5('---' || chr(10) || 'license: apache-2.0' || chr(10) || 'base_model: ' || b || chr(10)
  || 'tags:' || chr(10) || '- fine-tuned' || chr(10) || '- lora' || chr(10) || 'library_name: peft' || chr(10)
  || 'pipeline_tag: text-generation' || chr(10) || '---' || chr(10) || chr(10) || '# Adapter for ' || b || chr(10) || chr(10)
  || '| Field | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| Base model | ' || b || ' |' || chr(10)
  || '| Rank (r) | ' || coalesce(CAST(r AS VARCHAR), '{inv.DEFAULT_RANK}') || ' |' || chr(10)
  || '| Alpha | ' || coalesce(CAST(alpha AS VARCHAR), '{inv.DEFAULT_ALPHA}') || ' |' || chr(10)
  || '| Target modules | ' || modules || ' |' || chr(10) || '| Training steps | 2038 |') AS card_md5
FROM (SELECT *, coalesce(base, '{inv.DEFAULT_BASE_MODEL}') AS b FROM configs)
""")
def card_text(spark: Spark, folder: str) -> DataFrame:
    cards = inv.config_defaults(_configs(spark, folder), base=inv.DEFAULT_BASE_MODEL,
                                rank=inv.DEFAULT_RANK, alpha=inv.DEFAULT_ALPHA)
    path = scratch_path(spark, "cards")
    write_cards(cards.withColumn("card", inv.card_text()).repartition("artifact"), path)
    whole = spark.read.text(path, wholetext=True)
    return whole.select("artifact", F.md5(F.regexp_replace("value", "\n$", "")).alias("card_md5"))


@query("adapter_base", f"""
WITH {CONFIGS_SQL},
bases AS (SELECT 'base-' || lang AS base_model, count(*) AS n_docs FROM documents WHERE lang <> 'es' GROUP BY lang)
SELECT c.artifact, coalesce(c.base, 'base-fr') AS base_model, b.n_docs
FROM configs c LEFT JOIN bases b ON b.base_model = coalesce(c.base, 'base-fr')
""")
def adapter_base(spark: Spark, folder: str) -> DataFrame:
    bases = d.documents(spark, folder).filter(F.col("lang") != "es").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs")
    ).select(F.concat(F.lit("base-"), "lang").alias("base_model"), "n_docs")
    paired = reg.pair_adapters(_configs(spark, folder), bases, given="base-fr")
    return paired.select("artifact", "base_model", "n_docs")


@query("device_memory", """
SELECT vec_id // 8 AS host, CAST(count(*) AS INTEGER) AS n_devices, CAST(sum(label) AS DOUBLE) AS total_gb
FROM embeddings GROUP BY 1
""")
def device_memory(spark: Spark, folder: str) -> DataFrame:
    # Eight devices per host; memory is a whole number of GB.
    device = F.struct(
        (F.col("vec_id") % 8).cast("int").alias("index"), F.lit("gpu").alias("name"),
        F.col("label").cast("double").alias("total_memory_gb"),
    )
    rows = read_table(spark, folder, "embeddings")
    hosts = rows.groupBy(whole_div("vec_id", 8).alias("host")).agg(F.collect_list(device).alias("devices"))
    return hosts.select("host", F.size("devices").alias("n_devices"), inv.device_memory("devices").alias("total_gb"))


@query("parse_telemetry", f"""
WITH {d.LINES_SQL},
m AS (
  SELECT regexp_extract(line, '^\\[Rank (\\d+)\\] \\[MEM:([^\\]]*)\\] (RAM|GPU\\d+): ([\\d,]+)MB / ([\\d,]+)MB',
    ['rank', 'label', 'device', 'used', 'total']) AS x
  FROM lines WHERE line LIKE '%[MEM:%')
SELECT CAST(x.rank AS INTEGER) AS rank, x.label AS label, x.device AS device, count(*) AS n_lines,
  max(CAST(replace(x.used, ',', '') AS BIGINT)) AS peak_mb, max(CAST(replace(x.total, ',', '') AS BIGINT)) AS total_mb
FROM m GROUP BY 1, 2, 3
""")
def parse_telemetry(spark: Spark, folder: str) -> DataFrame:
    parsed = parse_memory_lines(d.memory_lines(spark, folder))
    return parsed.groupBy("rank", "label", "device").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("used_mb").alias("peak_mb"), F.max("total_mb").alias("total_mb")
    )


@query("device_csv", """
SELECT event_id, CAST(user_id AS INTEGER) AS device, CAST(floor(value) AS BIGINT) AS used_mb, CAST(1000 AS BIGINT) AS total_mb
FROM events WHERE event_type <> 'error'
""")
def device_csv(spark: Spark, folder: str) -> DataFrame:
    broken = F.col("event_type") == "error"
    line = F.concat_ws(
        ", ", F.col("user_id").cast("string"), F.floor("value").cast("string"), F.when(~broken, "1000")
    )
    return parse_device_csv(d.events(spark, folder).select("event_id", line.alias("line")))


@query("host_memory", """
WITH first_total AS (
  SELECT user_id, min_by(1000000 + event_id, event_id) AS kb FROM events WHERE event_type <> 'view' GROUP BY user_id),
first_free AS (
  SELECT user_id, min_by(CAST(floor(value * 1000) AS BIGINT), event_id) AS kb FROM events WHERE event_type = 'view' GROUP BY user_id),
mb AS (
  SELECT t.user_id AS host, t.kb // 1024 AS total_mb, t.kb // 1024 - f.kb // 1024 AS used_mb
  FROM first_total t JOIN first_free f ON f.user_id = t.user_id)
SELECT host, total_mb, used_mb, CAST(100 * used_mb AS DOUBLE) / total_mb AS used_percent FROM mb
""")
def memory_of_hosts(spark: Spark, folder: str) -> DataFrame:
    free = F.col("event_type") == "view"
    line = F.when(
        free, F.concat(F.lit("MemAvailable:   "), F.floor(F.col("value") * 1000).cast("string"), F.lit(" kB"))
    ).otherwise(F.concat(F.lit("MemTotal:  "), (F.col("event_id") + 1000000).cast("string"), F.lit(" kB")))
    lines = d.events(spark, folder).select(
        F.col("user_id").alias("host"), F.col("event_id").alias("line_no"), line.alias("line")
    )
    return host_memory(lines).filter(F.col("used_mb").isNotNull())
