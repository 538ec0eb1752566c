"""Selection among scored candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.operators import sampling as s

Spark = SparkSession

SEED = 7


def nucleus_sql(k: str) -> str:
    return f"""
{d.CANDIDATES_SQL},
heated AS (SELECT group_id, cand, score / 0.7 AS score FROM cands),
ranked AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, cand) AS rn FROM heated),
weighted AS (
  SELECT *, exp(score - max(score) OVER (PARTITION BY group_id)) AS w FROM ranked WHERE {k}),
scaled AS (SELECT *, w / sum(w) OVER (PARTITION BY group_id) AS prob FROM weighted),
massed AS (
  SELECT *, sum(prob) OVER (PARTITION BY group_id ORDER BY score DESC, cand ROWS UNBOUNDED PRECEDING) AS mass
  FROM scaled),
kept AS (SELECT group_id, cand, score, prob FROM massed WHERE mass - prob < 0.9 OR rn = 1)
"""


def pick_sql(k: str) -> str:
    return f"""
WITH {nucleus_sql(k)},
noisy AS (
  SELECT group_id, cand, ln(prob) - ln(-ln((CAST('0x' || substr(md5('{SEED}|' || group_id || '|' || cand), 1, 8) AS BIGINT)
    + 0.5::DOUBLE) / 4294967296.0::DOUBLE)) AS g
  FROM kept)
SELECT group_id, cand FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY g DESC, cand) AS n FROM noisy) WHERE n = 1
"""


GREEDY_SQL = f"""
WITH {d.CANDIDATES_SQL}
SELECT group_id, cand FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, cand) AS n FROM cands) WHERE n = 1
"""

TOP_50, ALL = "rn <= 50", "true"


@query("topk", f"""
WITH {d.CANDIDATES_SQL}
SELECT group_id, cand, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY group_id ORDER BY score DESC, cand) AS INTEGER) AS rank FROM cands)
WHERE rank <= 50
""")
def topk(spark: Spark, folder: str) -> DataFrame:
    return s.top_k(d.candidates(spark, folder)).select("group_id", "cand", "score", "rank")


def _kept(df: DataFrame) -> DataFrame:
    return df.select("group_id", "cand", F.round("prob", 9).alias("prob"))


@query("nucleus", f"WITH {nucleus_sql(TOP_50)} SELECT group_id, cand, round(prob, 9) AS prob FROM kept")
def nucleus(spark: Spark, folder: str) -> DataFrame:
    return _kept(s.nucleus(d.candidates(spark, folder)))


@query("nucleus_all", f"WITH {nucleus_sql(ALL)} SELECT group_id, cand, round(prob, 9) AS prob FROM kept")
def nucleus_all(spark: Spark, folder: str) -> DataFrame:
    return _kept(s.nucleus(d.candidates(spark, folder), k=None))


@query("greedy", GREEDY_SQL)
def greedy(spark: Spark, folder: str) -> DataFrame:
    return s.greedy(d.candidates(spark, folder))


@query("weighted_pick", pick_sql(TOP_50))
def weighted_pick(spark: Spark, folder: str) -> DataFrame:
    return s.weighted_pick(d.candidates(spark, folder), SEED)


@query("weighted_pick_cold", GREEDY_SQL)
def weighted_pick_cold(spark: Spark, folder: str) -> DataFrame:
    return s.weighted_pick(d.candidates(spark, folder), SEED, temperature=0)
