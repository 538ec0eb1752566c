"""Session replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.text import is_plain_exit
from chatweave.operators.sessions import (
    DEFAULT_SYSTEM,
    last_message_rows,
    open_inputs,
    read_inputs,
    session_state,
    turn_context,
)

Spark = SparkSession

# Positions per chunk here: sessions of ten conversations span several chunks.
SPAN = 16


@query("classify_input", f"""
WITH {d.STATE_SQL}
SELECT conv_id, turn, cmd, sys_arg, lower(u) IN ('quit', 'exit', 'q') AS plain_exit FROM argued
""")
def classify_input(spark: Spark, folder: str) -> DataFrame:
    rows = read_inputs(d.session_inputs(spark, folder))
    return rows.select("conv_id", "turn", "cmd", "sys_arg", is_plain_exit("u").alias("plain_exit"))


@query("session_exit", f"WITH {d.STATE_SQL} SELECT conv_id, turn, cmd FROM state WHERE exits = 0")
def session_exit(spark: Spark, folder: str) -> DataFrame:
    rows = open_inputs(session_state(d.session_inputs(spark, folder), span=SPAN))
    return rows.select("conv_id", "turn", "cmd")


@query("session_epochs", f"WITH {d.STATE_SQL} SELECT conv_id, turn, epoch FROM state")
def session_epochs(spark: Spark, folder: str) -> DataFrame:
    return session_state(d.session_inputs(spark, folder), span=SPAN).select("conv_id", "turn", "epoch")


@query("system_asof", f"""
WITH {d.STATE_SQL} SELECT conv_id, turn, coalesce(sys_set, '{DEFAULT_SYSTEM}') AS sys FROM state
""")
def system_asof(spark: Spark, folder: str) -> DataFrame:
    return session_state(d.session_inputs(spark, folder), span=SPAN).select("conv_id", "turn", "sys")


CONTEXT_SQL = f"""
WITH {d.STATE_SQL},
turns AS (
  SELECT *, coalesce(sys_set, '{DEFAULT_SYSTEM}') AS sys,
    count(reply) OVER (PARTITION BY conv_id, epoch ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kb
  FROM state WHERE exits = 0 AND cmd = 'turn'),
past AS (
  SELECT t.conv_id, t.turn, count(*) AS n_pairs, string_agg(h.u || '|' || h.reply || '|', '' ORDER BY h.turn) AS txt
  FROM turns t JOIN turns h ON h.conv_id = t.conv_id AND h.epoch = t.epoch AND h.reply IS NOT NULL
    AND h.kb BETWEEN t.kb - 10 AND t.kb - 1
  GROUP BY 1, 2)
SELECT t.conv_id, t.turn,
  CAST(coalesce(2 * p.n_pairs, 0) + CASE WHEN t.sys <> '' THEN 2 ELSE 1 END AS INTEGER) AS n_messages,
  md5(CASE WHEN t.sys <> '' THEN t.sys || '|' ELSE '' END || coalesce(p.txt, '') || t.u) AS contents_md5
FROM turns t LEFT JOIN past p ON p.conv_id = t.conv_id AND p.turn = t.turn
"""


def context_report(contexts: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("messages", lambda m: m["content"]), "|")
    return contexts.select("conv_id", "turn", F.size("messages").alias("n_messages"), F.md5(text).alias("contents_md5"))


@query("turn_context", CONTEXT_SQL)
def contexts(spark: Spark, folder: str) -> DataFrame:
    return context_report(turn_context(d.session_inputs(spark, folder)))


@query("turn_context_long", CONTEXT_SQL)
def contexts_long(spark: Spark, folder: str) -> DataFrame:
    # The route for sessions of several chunks.
    return context_report(turn_context(d.session_inputs(spark, folder), span=SPAN))


@query("last20", """
SELECT conv_id // 10 AS conv_id, turn, role, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id DESC, turn DESC) AS n FROM conversations)
WHERE n <= 20
""")
def last20(spark: Spark, folder: str) -> DataFrame:
    rows = d.conversations(spark, folder).select(
        F.expr("conv_id div 10").alias("conv_id"), "turn", "role", F.md5("text").alias("text_md5"),
        F.struct("conv_id", "turn").alias("position"),
    )
    return last_message_rows(rows, position="position").drop("position")
