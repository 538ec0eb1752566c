"""Operator inputs derived from the test tables, in Spark and in SQL.

The tables hold conversations and documents; sources, sessions, scores, listings and
log lines are rules over all their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.operators.canonical import exchanges
from chatweave.operators.joins import bounded_broadcast
from chatweave.session import cut_lineage
from chatweave.sources.tables import read_table

# Rows of conversation c begin at c times this: no turn number reaches it, so orders never collide.
ROW_ORD = 1 << 32

# SQL text of a piece split; the pattern is the same in both engines.
PIECES_SQL = r"'\p{L}+|\p{N}|[^\t\n\x0b\x0c\r \p{L}\p{N}]+'"


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "conversations")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events")


# Source A: answered user messages.
PAIRS_SQL = f"""
pairs AS (
  SELECT u.conv_id * {ROW_ORD} + u.turn AS row_ord, u.text AS input, a.text AS output
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')
"""


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    both = exchanges(conversations(spark, folder)).filter(F.col("reply").isNotNull())
    return both.select(
        (F.col("conv_id") * ROW_ORD + F.col("turn")).alias("row_ord"),
        F.col("text").alias("input"), F.col("reply").alias("output"),
    )


# Source B, string form: one document per chat; some systems are null or empty.
CHATS_SQL = """
chats AS (
  SELECT doc_id AS row_ord,
    CASE WHEN lang = 'de' THEN NULL WHEN lang = 'fr' THEN '' WHEN lang = 'es' THEN ' '
         ELSE source END AS system,
    text AS chat
  FROM documents)
"""


def chats(spark: SparkSession, folder: str) -> DataFrame:
    lang = F.col("lang")
    system = (
        F.when(lang == "de", F.lit(None).cast("string"))
        .when(lang == "fr", "").when(lang == "es", " ").otherwise(F.col("source"))
    )
    return documents(spark, folder).select(
        F.col("doc_id").alias("row_ord"), system.alias("system"), F.col("text").alias("chat")
    )


# Source B, list form: each exchange with the system message of its conversation.
CHAT_LISTS_SQL = f"""
chat_lists AS (
  SELECT u.conv_id * {ROW_ORD} + u.turn AS row_ord, s.text AS system, u.text AS u, a.text AS a
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
  WHERE u.role = 'user' AND a.role = 'assistant')
"""


def chat_lists(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations(spark, folder)
    systems = rows.filter((F.col("turn") == 0) & (F.col("role") == "system")).select(
        "conv_id", F.col("text").alias("system")
    )
    both = exchanges(rows).filter(F.col("reply").isNotNull()).join(bounded_broadcast(systems), "conv_id", "left")
    chat = F.array(
        F.struct(F.lit("user").alias("role"), F.col("text").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("reply").alias("content")),
    )
    return both.select(
        (F.col("conv_id") * ROW_ORD + F.col("turn")).alias("row_ord"), "system", chat.alias("chat")
    )


# Sessions of ten conversations each, one after the other: the turns of a conversation follow the last
# turn of the one before. Commands, blanks and failures by text length.
SESSIONS_SQL = """
spans AS (
  SELECT conv_id, max(turn) + 1 AS span FROM conversations WHERE role = 'user' GROUP BY conv_id),
skips AS (
  SELECT conv_id, CAST(coalesce(sum(span) OVER (PARTITION BY conv_id // 10 ORDER BY conv_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS skip FROM spans),
users AS (
  SELECT u.conv_id // 10 AS conv_id, s.skip + u.turn AS turn,
    u.text, length(u.text) AS n, a.text AS reply
  FROM conversations u JOIN skips s ON s.conv_id = u.conv_id LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'),
inputs AS (
  SELECT conv_id, turn,
    CASE WHEN n % 37 = 1 THEN ' /CLEAR' || chr(10)
         WHEN n % 23 = 2 THEN '/System ' || chr(160) || substr(text, 1, 20) || ' '
         WHEN n % 97 = 3 THEN '/quit'
         WHEN n % 89 = 4 THEN '/quit now'
         WHEN n % 29 = 5 THEN chr(9) || chr(160) || chr(28) || chr(8195)
         ELSE chr(12288) || text || chr(133) END AS text,
    CASE WHEN n % 11 = 6 THEN NULL ELSE reply END AS reply
  FROM users)
"""


def session_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Inputs (conv_id, turn, text, reply) with ``conv``, the conversation each is from."""
    rows = conversations(spark, folder)
    # A window over one row per conversation; the inputs meet it in a join.
    earlier = Window.partitionBy(F.expr("conv_id div 10")).orderBy("conv_id").rowsBetween(Window.unboundedPreceding, -1)
    skips = rows.filter(F.col("role") == "user").groupBy("conv_id").agg((F.max("turn") + 1).alias("span")).select(
        "conv_id", F.coalesce(F.sum("span").over(earlier), F.lit(0)).alias("skip"))
    both = exchanges(rows).join(skips, "conv_id").withColumn("n", F.length("text"))
    n, text = F.col("n"), F.col("text")
    changed = (
        F.when(n % 37 == 1, " /CLEAR\n")
        .when(n % 23 == 2, F.concat(F.lit("/System  "), F.substring(text, 1, 20), F.lit(" ")))
        .when(n % 97 == 3, "/quit")
        .when(n % 89 == 4, "/quit now")
        .when(n % 29 == 5, "\t \x1c ")
        .otherwise(F.concat(F.lit("　"), text, F.lit("\u0085")))
    )
    # Later branches read the inputs several times, so they become a table first.
    return cut_lineage(both.select(
        F.expr("conv_id div 10").alias("conv_id"),
        (F.col("skip") + F.col("turn")).alias("turn"),
        changed.alias("text"),
        F.when(n % 11 != 6, F.col("reply")).alias("reply"),
        F.col("conv_id").alias("conv"),
    ))


def input_times(inputs: DataFrame, pause: int = 0) -> DataFrame:
    """Session inputs with ``at``: a minute per turn, and ``pause`` minutes after every third conversation."""
    minutes = F.col("turn") + F.lit(pause) * F.expr("conv % 10 div 3")
    return inputs.withColumn("at", F.timestamp_seconds(F.lit(1_704_067_200) + minutes * 60)).drop("conv")


# Stripping in SQL, with the same characters.
STRIP_SQL = (
    r"regexp_replace({0}, '^[\t\n\x0b\x0c\r\x1c-\x1f \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}"
    r"\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\t\n\x0b\x0c\r\x1c-\x1f \x{{85}}\x{{a0}}"
    r"\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g')"
)

STATE_SQL = (
    SESSIONS_SQL
    + f"""
, stripped AS (
  SELECT conv_id, turn, {STRIP_SQL.format('text')} AS u, reply FROM inputs),
classified AS (
  SELECT *, CASE WHEN lower(u) IN ('/exit', '/quit') THEN 'exit'
                 WHEN lower(u) = '/clear' THEN 'clear'
                 WHEN starts_with(lower(u), '/system ') THEN 'system'
                 ELSE 'turn' END AS cmd
  FROM stripped WHERE u <> ''),
argued AS (
  SELECT *, CASE WHEN cmd = 'system' THEN {STRIP_SQL.format('substr(u, 9)')} END AS sys_arg
  FROM classified),
state AS (
  SELECT *,
    sum(CASE WHEN cmd = 'exit' THEN 1 ELSE 0 END) OVER w AS exits,
    CAST(sum(CASE WHEN cmd IN ('clear', 'system') THEN 1 ELSE 0 END) OVER w AS BIGINT) AS epoch,
    last_value(sys_arg IGNORE NULLS) OVER w AS sys_set
  FROM argued
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
"""
)


# Score rows: the 64 entries of each embedding.
CANDIDATES_SQL = """
cands AS (
  SELECT vec_id AS group_id, unnest(range(len(embedding))) AS cand,
    CAST(unnest(embedding) AS DOUBLE) * 20 AS score
  FROM embeddings)
"""


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    return rows.select(F.col("vec_id").alias("group_id"), F.posexplode("embedding").alias("cand", "s")).select(
        "group_id", F.col("cand").cast("long").alias("cand"),
        (F.col("s").cast("double") * 20).alias("score"),
    )


# File listings: one artifact per user, file names by event type.
LISTING_SQL = """
listing AS (
  SELECT 'run-' || (user_id * 7 + CAST(k AS BIGINT)) AS artifact,
    CASE event_type WHEN 'view' THEN 'adapter_config.json'
                    WHEN 'click' THEN 'adapter_model.safetensors'
                    ELSE 'optimizer-' || event_id || '.pt' END AS name,
    CAST(floor(value * 1000000) AS BIGINT) AS length
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))
"""


def listing(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder)
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    return rows.select(
        F.concat(F.lit("run-"), (F.col("user_id") * 7 + k).cast("string")).alias("artifact"),
        F.when(kind == "view", "adapter_config.json")
        .when(kind == "click", "adapter_model.safetensors")
        .otherwise(F.concat(F.lit("optimizer-"), F.col("event_id").cast("string"), F.lit(".pt"))).alias("name"),
        F.floor(F.col("value") * 1000000).cast("long").alias("length"),
    )


# Log lines: a memory line per event, RAM figures with thousands marks; some broken.
LINES_SQL = """
lines AS (
  SELECT ts AS ingest_ts,
    CASE WHEN event_type = 'error' THEN '[Rank ' || (user_id % 8) || '] TRAIN: starting...'
         WHEN event_type = 'view' THEN '[Rank ' || (user_id % 8) || '] [MEM:POST-GC] RAM: '
           || '1,' || lpad(CAST(user_id AS VARCHAR), 3, '0') || 'MB / 2,048MB (50.0%)'
         ELSE '[Rank ' || (user_id % 8) || '] [MEM:' || upper(event_type) || '] GPU' || (event_id % 4)
           || ': ' || CAST(floor(value) AS BIGINT) || 'MB / 1000MB' END AS line
  FROM events)
"""


def memory_lines(spark: SparkSession, folder: str) -> DataFrame:
    rank = (F.col("user_id") % 8).cast("string")
    head = F.concat(F.lit("[Rank "), rank, F.lit("] "))
    kind = F.col("event_type")
    ram = F.concat(
        head, F.lit("[MEM:POST-GC] RAM: 1,"), F.lpad(F.col("user_id").cast("string"), 3, "0"),
        F.lit("MB / 2,048MB (50.0%)"),
    )
    gpu = F.concat(
        head, F.lit("[MEM:"), F.upper(kind), F.lit("] GPU"), (F.col("event_id") % 4).cast("string"),
        F.lit(": "), F.floor("value").cast("string"), F.lit("MB / 1000MB"),
    )
    line = (
        F.when(kind == "error", F.concat(head, F.lit("TRAIN: starting...")))
        .when(kind == "view", ram).otherwise(gpu)
    )
    return events(spark, folder).select(
        F.col("ts").cast("timestamp").alias("ingest_ts"), line.alias("line")
    )
