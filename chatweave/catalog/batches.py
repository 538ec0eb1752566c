"""Training-set planning and checkpoint tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.tokens import PREPARE_MAX_LENGTH, byte_ids, truncate
from chatweave.operators import batching as b
from chatweave.plans.training import training_batches
from chatweave.session import scratch_path, spread
from chatweave.sources.tables import read_columns, write_columns

Spark = SparkSession

SEED = 42
LAYOUT = b.Layout(ranks=8, batch=16, accumulation=2)
PAD = 1


def _docs(spark: Spark, folder: str) -> DataFrame:
    return d.documents(spark, folder).select("doc_id", F.col("n_chars").alias("length"))


ORDER_SQL = f"""
ordered AS (
  SELECT doc_id, n_chars AS length,
    row_number() OVER (ORDER BY md5('{SEED}|0|' || doc_id), doc_id) - 1 AS idx, count(*) OVER () AS idx_total
  FROM documents)
"""

SHARD_SQL = f"""
{ORDER_SQL},
dealt AS (
  SELECT doc_id, length, unnest(range(idx, CAST(ceil(idx_total / {LAYOUT.ranks}) AS BIGINT) * {LAYOUT.ranks}, idx_total)) AS idx
  FROM ordered),
sharded AS (SELECT *, CAST(idx % {LAYOUT.ranks} AS INTEGER) AS rank, idx // {LAYOUT.ranks} AS rank_idx FROM dealt)
"""

BATCH_SQL = f"""
{SHARD_SQL},
batched AS (
  SELECT *, rank_idx // {LAYOUT.batch * LAYOUT.accumulation} AS step,
    CAST((rank_idx // {LAYOUT.batch}) % {LAYOUT.accumulation} AS INTEGER) AS micro,
    CAST(rank_idx % {LAYOUT.batch} AS INTEGER) AS slot
  FROM sharded)
"""


@query("seeded_order", f"WITH {ORDER_SQL} SELECT doc_id, idx, idx_total FROM ordered")
def seeded_order(spark: Spark, folder: str) -> DataFrame:
    return b.seeded_order(_docs(spark, folder), "doc_id", SEED).select("doc_id", "idx", "idx_total")


@query("rank_shards", f"WITH {SHARD_SQL} SELECT doc_id, idx, rank, rank_idx FROM sharded")
def rank_shards(spark: Spark, folder: str) -> DataFrame:
    ordered = b.seeded_order(_docs(spark, folder), "doc_id", SEED)
    return b.rank_shards(ordered, LAYOUT).select("doc_id", "idx", "rank", "rank_idx")


@query("step_batches", f"""
WITH {BATCH_SQL}
SELECT doc_id, idx, rank, step, micro, slot, length, max(length) OVER (PARTITION BY rank, step, micro) AS width
FROM batched
""")
def step_batches(spark: Spark, folder: str) -> DataFrame:
    plan = b.batch_plan(_docs(spark, folder), "doc_id", "length", LAYOUT, SEED)
    return plan.select("doc_id", "idx", "rank", "step", "micro", "slot", "length", "width")


BYTES_SQL = """list_transform(regexp_extract_all(hex(text), '..'),
    lambda h: 16 * (strpos('0123456789ABCDEF', h[1]) - 1) + strpos('0123456789ABCDEF', h[2]) - 1)"""


@query("pad_batches", f"""
WITH {BATCH_SQL},
coded AS (SELECT doc_id, list_slice({BYTES_SQL}, 1, 1024) AS ids FROM documents),
joined AS (
  SELECT b.doc_id, b.rank, b.step, b.micro, b.slot, c.ids,
    max(len(c.ids)) OVER (PARTITION BY b.rank, b.step, b.micro) AS width
  FROM batched b JOIN coded c ON c.doc_id = b.doc_id)
SELECT doc_id, rank, step, micro, slot, CAST(width AS INTEGER) AS width,
  md5(array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda i: {PAD})), ',')) AS ids_md5,
  CAST(len(ids) AS INTEGER) AS mask_ones, CAST(CASE WHEN len(ids) < width THEN len(ids) + 1 ELSE 0 END AS BIGINT) AS mask_zero_at,
  md5(array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda i: -100)), ',')) AS labels_md5
FROM joined
""")
def pad_batches(spark: Spark, folder: str) -> DataFrame:
    docs = spread(d.documents(spark, folder).select("doc_id", "text"), "doc_id")
    # The preparation stage stores its tokens; the training stage reads them.
    path = scratch_path(spark, "tokens")
    # A character has at least one byte, so texts are cut before they are split.
    ids = truncate(byte_ids(F.substring("text", 1, PREPARE_MAX_LENGTH)), PREPARE_MAX_LENGTH)
    write_columns(docs.select("doc_id", ids.alias("ids")).withColumn("n_ids", F.size("ids")), path)
    rows = training_batches(read_columns(spark, path), "doc_id", "ids", LAYOUT, PAD, SEED, length="n_ids")

    def digest(c: str):
        return F.md5(F.array_join(F.col(c).cast("array<string>"), ","))

    return rows.select(
        "doc_id", "rank", "step", "micro", "slot", "width",
        digest("input_ids").alias("ids_md5"),
        F.size(F.array_remove("attention_mask", 0)).alias("mask_ones"),
        F.array_position("attention_mask", 0).alias("mask_zero_at"),
        digest("labels").alias("labels_md5"),
    )


@query("padding_waste", f"""
WITH {BATCH_SQL},
wide AS (SELECT *, max(length) OVER (PARTITION BY rank, step, micro) AS width FROM batched)
SELECT rank, CAST(sum(length) AS BIGINT) AS tokens, CAST(sum(width) AS BIGINT) AS padded_tokens,
  round(1.0 - CAST(sum(length) AS DOUBLE) / CAST(sum(width) AS DOUBLE), 9) AS waste
FROM wide GROUP BY rank
""")
def padding_waste(spark: Spark, folder: str) -> DataFrame:
    plan = b.batch_plan(_docs(spark, folder), "doc_id", "length", LAYOUT, SEED)
    return b.padding_waste(plan).withColumn("waste", F.round("waste", 9))


RUNS = b.Layout(ranks=8, batch=56)

SCHEDULE_SQL = """
WITH sizes AS (SELECT lang, CAST(sum(n_chars) AS BIGINT) AS n_rows FROM documents GROUP BY lang),
planned AS (SELECT *, CAST(ceil(ceil(n_rows / 8) / 56) AS BIGINT) AS steps FROM sizes)
SELECT lang, n_rows, steps, step FROM (
  SELECT *, unnest(list_distinct(list_concat(range(100, steps + 1, 100), [steps]))) AS step FROM planned)
"""


@query("ckpt_schedule", SCHEDULE_SQL)
def ckpt_schedule(spark: Spark, folder: str) -> DataFrame:
    sizes = d.documents(spark, folder).groupBy("lang").agg(F.sum("n_chars").alias("n_rows"))
    return b.checkpoint_schedule(sizes, "n_rows", RUNS, every=100)


def _checkpoints(spark: Spark, folder: str) -> DataFrame:
    step = (F.col("event_id") % 40 + 1) * 100
    return d.events(spark, folder).select(F.col("user_id").alias("run"), step.alias("step")).distinct()


CHECKPOINTS_SQL = "ckpts AS (SELECT DISTINCT user_id AS run, (event_id % 40 + 1) * 100 AS step FROM events)"


@query("ckpt_retention", f"""
WITH {CHECKPOINTS_SQL}
SELECT run, step FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS n FROM ckpts) WHERE n <= 3
""")
def ckpt_retention(spark: Spark, folder: str) -> DataFrame:
    return b.keep_newest(_checkpoints(spark, folder), "run", "step")


@query("resume_point", f"""
WITH {CHECKPOINTS_SQL}
SELECT run, max(CASE WHEN step = 1000 THEN step END) AS fixed, max(step) AS newest FROM ckpts GROUP BY run
""")
def resume_point(spark: Spark, folder: str) -> DataFrame:
    rows = _checkpoints(spark, folder)
    fixed = b.resume_point(rows, "run", "step").withColumnRenamed("resume_step", "fixed")
    newest = b.resume_point(rows, "run", "step", rule="newest").withColumnRenamed("resume_step", "newest")
    return fixed.join(newest, "run")


@query("metric_downsample", """
SELECT event_id // 10 AS bucket, max(event_id + 1) AS last_step, round(avg(value), 6) AS mean_value
FROM events GROUP BY 1
""")
def metric_downsample(spark: Spark, folder: str) -> DataFrame:
    metrics = d.events(spark, folder).select((F.col("event_id") + 1).alias("step"), "value")
    rows = b.downsample_metrics(metrics, "step", "value")
    return rows.withColumn("mean_value", F.round("mean_value", 6))
