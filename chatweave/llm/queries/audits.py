"""Queries of the audit of filters and of the toxicity scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.filter_audit import audit_filters
from chatweave.llm.queries.native import ASCII_SPACE
from chatweave.llm.toxicity import score_toxicity


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit_filters(spark, f"{sf_dir}/documents.parquet", labels)


OP12_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS words FROM documents),
f AS (SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
      FROM a p, a q, a r, a s, a t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
        AND len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS filter, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before
      FROM o, range(1, 6) AS u(step))
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter,
  CAST(sum(CASE WHEN mask & (bit + CAST(before AS INTEGER)) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM c, s GROUP BY part, filter_order, step, filter
"""


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    scored = score_toxicity(docs, labels, learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op12_filter_interaction_audit": op12_filter_interaction_audit, "op13_toxicity": op13_toxicity}
ORACLE = {"op12_filter_interaction_audit": OP12_SQL}
