"""Sources, canonical rows, templates and short displays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.messages import last_messages, prompt_messages, render
from chatweave.functions.text import base_name, is_blank, preview, strip
from chatweave.operators import ordered
from chatweave.operators.canonical import canonical_chats, canonical_pairs, mix_sources, nest_messages
from chatweave.operators.sessions import last_message_rows
from chatweave.plans.prepare import conversation_tokens, prepare_dataset, rendered_rows
from chatweave.session import scratch_path
from chatweave.sources.tables import (
    materialise,
    publish,
    read_columns,
    read_in_storage_order,
    read_jsonl,
    read_prefix,
    read_table,
    write_columns,
    write_jsonl,
    write_sharded,
)

Spark = SparkSession


def _roles(m: str = "messages") -> Column:
    return F.array_join(F.transform(m, lambda x: x["role"]), ",")


def _contents_md5(m: str = "messages") -> Column:
    return F.md5(F.array_join(F.transform(m, lambda x: x["content"]), "|"))


def _brief(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, F.size("messages").alias("n_messages"), _roles().alias("roles"),
        _contents_md5().alias("contents_md5"),
    )


SFT_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, regexp_extract_all(
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), {d.PIECES_SQL}) AS p
  FROM conversations),
g AS (
  SELECT conv_id, count(*) AS n_messages, CAST(sum(len(p)) AS BIGINT) AS n_tokens,
    flatten(list(p ORDER BY turn)) AS ps
  FROM m GROUP BY conv_id)
SELECT conv_id, n_messages, n_tokens, CAST(least(len(ps), 1024) AS INTEGER) AS n_kept,
  md5(array_to_string(ps[1:1024], ' ')) AS kept_md5
FROM g
"""


@query("sft_prepare", SFT_SQL)
def sft_prepare(spark: Spark, folder: str) -> DataFrame:
    return conversation_tokens(d.conversations(spark, folder)).select(
        "conv_id", "n_messages", "n_tokens", F.size("pieces").alias("n_kept"),
        F.md5(F.array_join("pieces", " ")).alias("kept_md5"),
    )


@query("head_slice", "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 700")
def head_slice(spark: Spark, folder: str) -> DataFrame:
    # The route for large prefixes, whatever the size here.
    head = ordered.head_slice(d.documents(spark, folder), ["doc_id"], 700, in_one_task=0)
    return head.select("doc_id", F.md5("text").alias("text_md5"))


@query("head_slice_small", """
SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations ORDER BY conv_id, turn LIMIT 60
""")
def head_slice_small(spark: Spark, folder: str) -> DataFrame:
    head = read_prefix(d.conversations(spark, folder), ["conv_id", "turn"], 60)
    return head.select("conv_id", "turn", F.md5("text").alias("text_md5"))


@query("storage_prefix", """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_ord, doc_id, md5(text) AS text_md5
FROM documents ORDER BY doc_id LIMIT 150
""")
def storage_prefix(spark: Spark, folder: str) -> DataFrame:
    # Files hold consecutive key ranges, so storage order is key order.
    path = scratch_path(spark, "stored")
    docs = d.documents(spark, folder).select("doc_id", "text")
    docs.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    rows = read_in_storage_order(spark, path, 150)
    return rows.select("row_ord", "doc_id", F.md5("text").alias("text_md5"))


@query("row_counts", """
SELECT 'conversations' AS tbl, count(*) AS n FROM conversations
UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'events', count(*) FROM events
""")
def row_counts(spark: Spark, folder: str) -> DataFrame:
    def count(name: str) -> DataFrame:
        table = read_table(spark, folder, name)
        return table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")

    return count("conversations").union(count("documents")).union(count("events"))


@query("canonical_pairs", f"""
WITH {d.PAIRS_SQL}
SELECT row_ord, 2 AS n_messages, 'user,assistant' AS roles,
  md5(input || '|' || output) AS contents_md5
FROM pairs
""")
def pairs(spark: Spark, folder: str) -> DataFrame:
    return _brief(canonical_pairs(d.pairs(spark, folder), keep=("row_ord",)), "row_ord")


CHAT_HEAD_SQL = "(system IS NOT NULL AND system <> '')"


@query("canonical_chats", f"""
WITH {d.CHATS_SQL}
SELECT row_ord, CASE WHEN {CHAT_HEAD_SQL} THEN 2 ELSE 1 END AS n_messages,
  CASE WHEN {CHAT_HEAD_SQL} THEN 'system,user' ELSE 'user' END AS roles,
  md5(CASE WHEN {CHAT_HEAD_SQL} THEN system || '|' || chat ELSE chat END) AS contents_md5
FROM chats
""")
def chat_strings(spark: Spark, folder: str) -> DataFrame:
    return _brief(canonical_chats(d.chats(spark, folder), keep=("row_ord",)), "row_ord")


@query("canonical_chat_lists", f"""
WITH {d.CHAT_LISTS_SQL}
SELECT row_ord, CASE WHEN {CHAT_HEAD_SQL} THEN 3 ELSE 2 END AS n_messages,
  CASE WHEN {CHAT_HEAD_SQL} THEN 'system,user,assistant' ELSE 'user,assistant' END AS roles,
  md5(CASE WHEN {CHAT_HEAD_SQL} THEN system || '|' ELSE '' END || u || '|' || a) AS contents_md5
FROM chat_lists
""")
def chat_lists(spark: Spark, folder: str) -> DataFrame:
    return _brief(canonical_chats(d.chat_lists(spark, folder), keep=("row_ord",)), "row_ord")


def _mixed(spark: Spark, folder: str) -> DataFrame:
    first = canonical_pairs(d.pairs(spark, folder), keep=("row_ord",))
    second = canonical_chats(d.chats(spark, folder), keep=("row_ord",))
    return mix_sources(first, second)


MIXED_SQL = f"""
{d.PAIRS_SQL}, {d.CHATS_SQL},
mixed AS (
  SELECT 0 AS src_ord, row_ord, ['user', 'assistant'] AS roles, [input, output] AS contents FROM pairs
  UNION ALL
  SELECT 1, row_ord, CASE WHEN {CHAT_HEAD_SQL} THEN ['system', 'user'] ELSE ['user'] END,
    CASE WHEN {CHAT_HEAD_SQL} THEN [system, chat] ELSE [chat] END
  FROM chats),
rendered AS (
  SELECT src_ord, row_ord, roles, array_to_string(list_transform(range(1, len(roles) + 1),
    lambda i: '<|im_start|>' || roles[i] || chr(10) || contents[i] || '<|im_end|>' || chr(10)), '') AS text
  FROM mixed)
"""


@query("mix_sources", f"""
WITH {MIXED_SQL}
SELECT src_ord, row_ord, CAST(len(roles) AS INTEGER) AS n_messages,
  array_to_string(roles, ',') AS roles, md5(array_to_string(contents, '|')) AS contents_md5
FROM mixed
""")
def mixed(spark: Spark, folder: str) -> DataFrame:
    return _brief(_mixed(spark, folder), "src_ord", "row_ord")


@query("progress_counts", f"""
WITH {MIXED_SQL} SELECT src_ord, count(*) AS n FROM mixed GROUP BY src_ord
""")
def progress_counts(spark: Spark, folder: str) -> DataFrame:
    return _mixed(spark, folder).groupBy("src_ord").agg(F.count(F.lit(1)).alias("n"))


@query("render_chatml", f"""
WITH {MIXED_SQL}
SELECT src_ord, row_ord, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5 FROM rendered
""")
def render_chatml(spark: Spark, folder: str) -> DataFrame:
    return rendered_rows(_mixed(spark, folder)).select(
        "src_ord", "row_ord", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query("render_default_system", f"""
WITH {MIXED_SQL}
SELECT src_ord, row_ord, md5(CASE WHEN roles[1] = 'system' THEN text ELSE
  '<|im_start|>system' || chr(10) || 'Be brief.' || '<|im_end|>' || chr(10) || text END) AS text_md5
FROM rendered
""")
def render_default_system(spark: Spark, folder: str) -> DataFrame:
    return rendered_rows(_mixed(spark, folder), default_system="Be brief.").select(
        "src_ord", "row_ord", F.md5("text").alias("text_md5")
    )


@query("render_prompt", f"""
WITH {d.CHATS_SQL}
SELECT row_ord, md5(
  CASE WHEN {CHAT_HEAD_SQL} THEN '<|im_start|>system' || chr(10) || system || '<|im_end|>' || chr(10) ELSE '' END
  || '<|im_start|>user' || chr(10) || chat || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
  ) AS text_md5
FROM chats
""")
def render_prompt(spark: Spark, folder: str) -> DataFrame:
    messages = prompt_messages("chat", F.col("system"))
    return d.chats(spark, folder).select(
        "row_ord", F.md5(render(messages, generation_prompt=True)).alias("text_md5")
    )


@query("prepare_dataset", f"""
WITH {MIXED_SQL},
kept AS (
  SELECT *, row_number() OVER (PARTITION BY src_ord ORDER BY row_ord) AS n FROM rendered)
SELECT src_ord, row_ord, md5(text) AS text_md5 FROM kept
WHERE (src_ord = 0 AND n <= 150) OR (src_ord = 1 AND n <= 1000000)
""")
def prepared(spark: Spark, folder: str) -> DataFrame:
    rows = prepare_dataset(d.pairs(spark, folder), d.chats(spark, folder), 150, 1_000_000)
    return rows.select("src_ord", "row_ord", F.md5("text").alias("text_md5"))


NEST_SQL = """
SELECT conv_id, turn // 4 AS part, CAST(count(*) AS INTEGER) AS n_messages,
  md5(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)) AS text_md5
FROM conversations GROUP BY 1, 2
"""


@query("nest_messages", NEST_SQL)
def nested(spark: Spark, folder: str) -> DataFrame:
    # Small parts, so that conversations of eight messages have several.
    rows = nest_messages(d.conversations(spark, folder), part_size=4)
    return rows.select(
        "conv_id", "part", F.size("messages").alias("n_messages"),
        F.md5(render("messages")).alias("text_md5"),
    )


@query("last_messages", """
WITH kept AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations)
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages,
  md5(string_agg(text, '|' ORDER BY turn)) AS contents_md5
FROM kept WHERE n <= 4 GROUP BY conv_id
""")
def last_of_array(spark: Spark, folder: str) -> DataFrame:
    rows = nest_messages(last_message_rows(d.conversations(spark, folder), n=4))
    last = rows.withColumn("messages", last_messages("messages", 4))
    return last.select("conv_id", F.size("messages").alias("n_messages"), _contents_md5().alias("contents_md5"))


@query("preview", """
SELECT conv_id, turn, substr(text, 1, 50) || '...' AS short, substr(text, 1, 100) || '...' AS longer
FROM conversations
""")
def previews(spark: Spark, folder: str) -> DataFrame:
    return d.conversations(spark, folder).select(
        "conv_id", "turn", preview("text", 50).alias("short"), preview("text", 100).alias("longer")
    )


@query("base_name", """
SELECT doc_id, list_extract(string_split(source || '/' || lang || '/' || doc_id, '/'), -1) AS name
FROM documents
""")
def base_names(spark: Spark, folder: str) -> DataFrame:
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return d.documents(spark, folder).select("doc_id", base_name(path).alias("name"))


@query("blank_filter", f"""
WITH {d.SESSIONS_SQL}
SELECT conv_id, turn, md5({d.STRIP_SQL.format('text')}) AS text_md5 FROM inputs
WHERE {d.STRIP_SQL.format('text')} <> ''
""")
def blank_filter(spark: Spark, folder: str) -> DataFrame:
    rows = d.session_inputs(spark, folder).filter(~is_blank("text"))
    return rows.select("conv_id", "turn", F.md5(strip("text")).alias("text_md5"))


@query("enumerate_prompts", """
SELECT row_number() OVER (ORDER BY conv_id, turn) AS n, conv_id, turn, md5(text) AS text_md5
FROM conversations WHERE role = 'user'
""")
def enumerate_prompts(spark: Spark, folder: str) -> DataFrame:
    users = d.conversations(spark, folder).filter(F.col("role") == "user")
    narrow = users.select("conv_id", "turn", F.md5("text").alias("text_md5"))
    return ordered.enumerate_rows(narrow, ["conv_id", "turn"])


@query("jsonl_roundtrip", f"""
WITH {MIXED_SQL}
SELECT md5(text) AS text_md5, count(*) AS n FROM rendered GROUP BY 1
""")
def jsonl_roundtrip(spark: Spark, folder: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    write_jsonl(_mixed(spark, folder), path, order=["src_ord", "row_ord"])
    rows = read_jsonl(spark, path).select(F.md5(render("messages")).alias("text_md5"))
    return rows.groupBy("text_md5").agg(F.count(F.lit(1)).alias("n"))


@query("columns_roundtrip", f"""
WITH {MIXED_SQL} SELECT src_ord, row_ord, md5(text) AS text_md5 FROM rendered
""")
def columns_roundtrip(spark: Spark, folder: str) -> DataFrame:
    path = scratch_path(spark, "columns")
    write_columns(rendered_rows(_mixed(spark, folder)), path)
    return read_columns(spark, path).select("src_ord", "row_ord", F.md5("text").alias("text_md5"))


@query("materialise", f"""
WITH {MIXED_SQL} SELECT src_ord, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM rendered GROUP BY src_ord
""")
def materialised(spark: Spark, folder: str) -> DataFrame:
    path, params = scratch_path(spark, "prepared"), {"template": "chatml"}

    def build() -> DataFrame:
        return rendered_rows(_mixed(spark, folder))

    materialise(spark, path, params, build)
    again = materialise(spark, path, params, build)
    return again.groupBy("src_ord").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("long")).alias("n_chars")
    )


@query("publish_revision", """
SELECT CASE WHEN lang = 'en' THEN 'main' ELSE 'other' END AS revision, lang, count(*) AS n
FROM documents GROUP BY 1, 2
""")
def publish_revision(spark: Spark, folder: str) -> DataFrame:
    path, docs = scratch_path(spark, "published"), d.documents(spark, folder)
    others = docs.filter(F.col("lang") != "en").select("doc_id", "lang")
    publish(others, path)
    publish(others, path, "other")
    publish(docs.filter(F.col("lang") == "en").select("doc_id", "lang"), path)
    return spark.read.parquet(path).groupBy("revision", "lang").agg(F.count(F.lit(1)).alias("n"))


SHARD_BYTES = 200_000

SHARDS_SQL = f"""
sized AS (
  SELECT doc_id, text, CAST(strlen(text) AS BIGINT) AS bytes FROM documents),
placed AS (
  SELECT *, CAST(coalesce(sum(bytes) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS BIGINT) AS bytes_before FROM sized)
"""


@query("byte_shards", f"""
WITH {SHARDS_SQL}
SELECT doc_id, bytes, bytes_before, bytes_before // {SHARD_BYTES} AS shard FROM placed
""")
def byte_shards(spark: Spark, folder: str) -> DataFrame:
    sizes = d.documents(spark, folder).select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    return ordered.byte_shards(sizes, "doc_id", "bytes", SHARD_BYTES)


@query("sharded_write", f"""
WITH {SHARDS_SQL}
SELECT bytes_before // {SHARD_BYTES - 100_000} AS shard, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes,
  sum(bytes) <= {SHARD_BYTES} AS within
FROM placed GROUP BY 1
""")
def sharded_write(spark: Spark, folder: str) -> DataFrame:
    path = scratch_path(spark, "sharded")
    write_sharded(
        d.documents(spark, folder), path, "doc_id", "text", SHARD_BYTES, max_row_bytes=100_000
    )
    size = F.sum(F.octet_length("text").cast("long"))
    return spark.read.parquet(path).groupBy(F.col("shard").cast("long").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"), size.alias("bytes"), (size <= SHARD_BYTES).alias("within")
    )
