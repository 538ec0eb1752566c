"""Queries of the operators that run on Spark expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.chat_format import format_chats, read_loss, read_turns
from chatweave.llm.line_dedup import drop_repeated_lines

ASCII_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    out = format_chats(given.unionByName(added))
    read = out.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"),
                      read_turns(F.col("formatted")).alias("turns"),
                      F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP7_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(text) + 4 * (length(text) - length(replace(text, '&', '')))
    + 3 * (length(text) - length(replace(replace(text, '<', ''), '[', ''))) AS n,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN before = role THEN 5 ELSE length(role) + 11 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"))


OP10_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], {ASCII_SPACE}), {LOWER}) AS k
      FROM d, unnest(range(1, len(ls) + 1)) AS u(i)),
often AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20
          GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, l.i, l.line, often.top IS NOT NULL AND often.top <> l.doc_id AS gone
      FROM l LEFT JOIN often ON l.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

QUERIES = {"op7_chat_formatting": op7_chat_formatting, "op10_line_dedup": op10_line_dedup}
ORACLE = {"op7_chat_formatting": OP7_SQL, "op10_line_dedup": OP10_SQL}
