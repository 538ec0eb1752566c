"""Line files, published revisions, mixed chats, templates, job reports and display formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.messages import prompt_messages, render
from chatweave.functions.templates import TEMPLATES, ChatTemplate, compile_template
from chatweave.functions.text import mebibytes, one_decimal, thousands, two_decimals
from chatweave.functions.tokens import byte_ids, pad_id, padded
from chatweave.operators.canonical import canonical_chats, canonical_pairs
from chatweave.plans.artifacts import artifact_report
from chatweave.plans.progress import write_all
from chatweave.session import scratch_path
from chatweave.sources.prompts import prompt_table
from chatweave.sources.published import history, publish_commit, read_published
from chatweave.sources.tables import path_exists, require_path
from chatweave.sources.telemetry import BROKEN, read_device_lines, read_lines
from chatweave.streaming.run import run_to_end
from chatweave.streaming.telemetry import memory_peaks

Spark = SparkSession


# Device files: most events as three fields, errors as two, views as four or as words.
DEVICE_SQL = """
SELECT CASE WHEN ok THEN CAST(event_id % 4 AS INTEGER) END AS device, CASE WHEN ok THEN CAST(floor(value) AS BIGINT) END AS used_mb,
  CASE WHEN ok THEN 1000::BIGINT END AS total_mb, CASE WHEN NOT ok THEN line END AS broken_line, count(*) AS n_lines
FROM (SELECT event_id, value, event_type <> 'error' AND event_type <> 'view' AS ok,
  CASE WHEN event_type = 'error' THEN (event_id % 4) || ', ' || CAST(floor(value) AS BIGINT)
       WHEN event_type = 'view' AND event_id % 2 = 0 THEN (event_id % 4) || ', ' || CAST(floor(value) AS BIGINT) || ', 1000, 7'
       WHEN event_type = 'view' THEN (event_id % 4) || ', none, 1000' END AS line
  FROM events)
GROUP BY ALL
"""


def _device_lines(spark: Spark, folder: str) -> DataFrame:
    kind, odd = F.col("event_type"), F.col("event_id") % 2 == 1
    device, used = (F.col("event_id") % 4).cast("string"), F.floor("value").cast("string")
    fields = (
        F.when(kind == "error", F.concat_ws(", ", device, used))
        .when((kind == "view") & odd, F.concat_ws(", ", device, F.lit("none"), F.lit("1000")))
        .when(kind == "view", F.concat_ws(", ", device, used, F.lit("1000"), F.lit("7")))
        .otherwise(F.concat_ws(", ", device, used, F.lit("1000")))
    )
    return d.events(spark, folder).select(fields.alias("value"), (F.col("event_id") % 3).alias("host"))


def _by_line(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device", "used_mb", "total_mb", BROKEN).agg(F.count(F.lit(1)).alias("n_lines"))


@query("device_files", DEVICE_SQL)
def device_files(spark: Spark, folder: str) -> DataFrame:
    path = scratch_path(spark, "device-files")
    _device_lines(spark, folder).write.partitionBy("host").text(path)
    return _by_line(read_device_lines(read_lines(spark, path, names="*.txt")))


@query("stream_device_files", DEVICE_SQL)
def stream_device_files(spark: Spark, folder: str) -> DataFrame:
    root = scratch_path(spark, "device-files")
    _device_lines(spark, folder).repartition(6).write.partitionBy("host").text(f"{root}/in")
    stream = read_device_lines(read_lines(spark, f"{root}/in", stream=True, files_per_batch=5))
    return _by_line(run_to_end(spark, stream.drop("file"), f"{root}/out", f"{root}/state"))


@query("memory_files", f"""
WITH {d.LINES_SQL},
m AS (
  SELECT regexp_extract(line, '^\\[Rank (\\d+)\\] \\[MEM:([^\\]]*)\\] (RAM|GPU\\d+): ([\\d,]+)MB / ([\\d,]+)MB',
    ['rank', 'label', 'device', 'used', 'total']) AS x
  FROM lines WHERE line LIKE '%[MEM:%')
SELECT CAST(x.rank AS INTEGER) AS rank, x.label AS label, x.device AS device,
  max(CAST(replace(x.used, ',', '') AS BIGINT)) AS peak_mb, count(*) AS n_lines
FROM m GROUP BY 1, 2, 3
""")
def memory_files(spark: Spark, folder: str) -> DataFrame:
    """Log files as lines, with the time of their file as event time of the peaks."""
    path = scratch_path(spark, "logs")
    d.memory_lines(spark, folder).select("line").repartition(4).write.text(path)
    peaks = memory_peaks(read_lines(spark, path).drop("file"), "1 day", delay=None)
    # One run may write files before and after midnight.
    return peaks.groupBy("rank", "label", "device").agg(F.max("peak_mb").alias("peak_mb"), F.sum("n_lines").alias("n_lines"))


@query("publish_history", """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (lang = 'en') AS en FROM documents)
SELECT 'main' AS revision, 0::BIGINT AS number, NULL::BIGINT AS parent, 'all' AS message, n AS n_rows, n AS n_read FROM n
UNION ALL SELECT 'main', 1, 0, 'English only', en, en FROM n
UNION ALL SELECT 'main', 2, 1, 'nothing', 0, 0 FROM n
UNION ALL SELECT 'step/2038', 0, NULL, 'the rest', n - en, n - en FROM n
""")
def publish_history(spark: Spark, folder: str) -> DataFrame:
    path, docs = scratch_path(spark, "published"), d.documents(spark, folder).select("doc_id", "lang")
    publish_commit(docs, path, message="all")
    publish_commit(docs.filter(F.col("lang") == "en"), path, message="English only")
    publish_commit(docs.filter(F.col("lang") != "en"), path, "step/2038", "the rest")
    publish_commit(docs.filter(F.col("lang") == "none"), path, message="nothing")
    told = history(spark, path)
    read = None
    for revision, numbers in (("main", (0, 1, None)), ("step/2038", (None,))):
        for n in numbers:
            one = read_published(spark, path, revision, n).agg(F.count(F.lit(1)).alias("n_read")).select(
                F.lit(revision).alias("revision"), F.lit(n).cast("bigint").alias("asked"), "n_read")
            read = one if read is None else read.unionByName(one)
    last = told.groupBy("revision").agg(F.max("number").alias("last"))
    read = read.join(last, "revision").select("revision", F.coalesce("asked", "last").alias("number"), "n_read")
    return told.join(read, ["revision", "number"]).select("revision", "number", "parent", "message", "n_rows", "n_read")


MIXED_CHATS_SQL = f"""
WITH {d.CHATS_SQL}, {d.CHAT_LISTS_SQL},
h AS (
  SELECT 'text' AS kind, row_ord, row_ord % 50 = 7 AS broken, system, ['user'] AS roles, [chat] AS contents FROM chats
  UNION ALL SELECT 'list', row_ord, row_ord % 50 = 7, system, ['user', 'assistant'], [u, a] FROM chat_lists)
SELECT kind, row_ord,
  CASE WHEN broken THEN NULL WHEN system <> '' THEN 'system,' || array_to_string(roles, ',') ELSE array_to_string(roles, ',') END AS roles,
  CASE WHEN NOT broken THEN md5(array_to_string(CASE WHEN system <> '' THEN list_prepend(system, contents) ELSE contents END, '|')) END AS contents_md5,
  CASE WHEN broken AND kind = 'text' THEN 'chat is BIGINT' WHEN broken THEN 'chat has a message without a role' END AS error
FROM h
"""


@query("canonical_mixed_chats", MIXED_CHATS_SQL)
def mixed_chats(spark: Spark, folder: str) -> DataFrame:
    """JSON lines whose chat is a string in some rows, a list in others, and now and then neither."""
    broken = F.col("row_ord") % 50 == 7
    texts = d.chats(spark, folder).select(F.lit("text").alias("kind"), "row_ord", "system", F.when(
        broken, F.col("row_ord").cast("string")).otherwise(F.to_json(F.struct(F.col("chat").alias("x")))).alias("j"))
    role = F.transform("chat", lambda m: F.struct(m["content"].alias("content")))
    lists = d.chat_lists(spark, folder).select(F.lit("list").alias("kind"), "row_ord", "system", F.when(
        broken, F.to_json(F.struct(role.alias("x")))).otherwise(F.to_json(F.struct(F.col("chat").alias("x")))).alias("j"))
    # The chat's own JSON is put into the line as it is.
    chat = F.regexp_extract("j", r"(?s)^\{\"x\":(.*)\}$", 1)
    head = F.to_json(F.struct("kind", "row_ord", "system"))
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"chat":'), F.when(chat == "", F.col("j")).otherwise(chat), F.lit("}"))
    path = scratch_path(spark, "mixed-chats")
    texts.unionByName(lists).select(line.alias("value")).write.text(path)
    rows = spark.read.schema("kind string, row_ord bigint, system string, chat variant").option("mode", "FAILFAST").json(path)
    found = canonical_chats(rows, keep=("kind", "row_ord"), on_null="flag")
    return found.select(
        "kind", "row_ord", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "|")).alias("contents_md5"), "error")


TEMPLATE_SQL = f"""
WITH {d.CHAT_LISTS_SQL},
c AS (SELECT row_ord, nullif(system, '') AS s, u, a, {d.STRIP_SQL.format("coalesce(system, '')")} AS s2,
  {d.STRIP_SQL.format('u')} AS u2, {d.STRIP_SQL.format('a')} AS a2 FROM chat_lists)
SELECT row_ord,
  md5(coalesce('<|im_start|>system' || chr(10) || s || '<|im_end|>' || chr(10), '') || '<|im_start|>user' || chr(10) || u || '<|im_end|>' || chr(10)
    || '<|im_start|>assistant' || chr(10) || a || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) AS chatml,
  md5('<|begin_of_text|>' || CASE WHEN s IS NULL THEN '' ELSE '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || s2 || '<|eot_id|>' END
    || '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || u2 || '<|eot_id|>'
    || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || a2 || '<|eot_id|>'
    || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)) AS headers,
  md5('<s>[INST] ' || CASE WHEN s IS NULL THEN '' ELSE '<<SYS>>' || chr(10) || s2 || chr(10) || '<</SYS>>' || chr(10) || chr(10) END
    || u2 || ' [/INST]' || ' ' || a2 || ' </s>') AS inst
FROM c
"""


@query("render_templates", TEMPLATE_SQL)
def render_templates(spark: Spark, folder: str) -> DataFrame:
    """Chats by three templates, each read from its JSON."""
    rows = canonical_chats(d.chat_lists(spark, folder), keep=("row_ord",))
    read = {name: ChatTemplate.from_json(t.to_json()) for name, t in TEMPLATES.items()}
    return rows.select("row_ord", *[F.md5(compile_template(t, "messages", answer=True)).alias(name) for name, t in read.items()])


@query("job_progress", f"""
WITH {d.PAIRS_SQL}, {d.CHATS_SQL}, p AS (SELECT count(*) AS n FROM pairs), c AS (SELECT count(*) AS n FROM chats)
SELECT 'rendered' AS sink, NULL AS source, p.n + c.n AS n_rows, true AS timed FROM p, c
UNION ALL SELECT 'rendered', 'pairs', n, true FROM p
UNION ALL SELECT 'rendered', 'chats', n, true FROM c
UNION ALL SELECT 'pairs', NULL, n, true FROM p
UNION ALL SELECT 'pairs', 'pairs', n, true FROM p
UNION ALL SELECT 'pairs', 'chats', 0, true FROM c
""")
def job_progress(spark: Spark, folder: str) -> DataFrame:
    root = scratch_path(spark, "job")
    first = canonical_pairs(d.pairs(spark, folder)).withColumn("source", F.lit("pairs"))
    second = canonical_chats(d.chats(spark, folder)).withColumn("source", F.lit("chats"))
    rendered = first.unionByName(second).select("source", render("messages").alias("text"))
    told = write_all(spark, {"rendered": (rendered, f"{root}/rendered"), "pairs": (first, f"{root}/pairs")}, "source", ("pairs", "chats"))
    timed = (F.col("seconds") > 0) & (F.col("rows_per_second") == F.col("n_rows") / F.col("seconds"))
    return told.select("sink", "source", "n_rows", timed.alias("timed"))


@query("prompt_rows", """
WITH p AS (SELECT row_number() OVER (ORDER BY item_id) AS idx, item_id, text FROM benchmark)
SELECT CAST(idx AS INTEGER) AS idx, CASE WHEN idx % 3 <> 1 THEN 'item ' || item_id END AS name,
  CASE WHEN idx % 3 = 0 THEN 'Be brief.' END AS system, md5(text) AS prompt_md5,
  CASE WHEN idx % 3 = 0 THEN 64 ELSE 512 END AS max_new_tokens, CASE WHEN idx % 3 = 0 THEN 2 ELSE 1 END AS n_messages
FROM p
""")
def prompt_rows(spark: Spark, folder: str) -> DataFrame:
    # The benchmark is a short list, as prompts written by hand are.
    given = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").collect()
    prompts: list = []
    for i, r in enumerate(given, 1):
        named = {"name": f"item {r['item_id']}", "prompt": r["text"], "system": "Be brief.", "max_new_tokens": 64}
        prompts.append(r["text"] if i % 3 == 1 else (named["name"], r["text"]) if i % 3 == 2 else named)
    rows = prompt_table(spark, prompts)
    return rows.select("idx", "name", "system", F.md5("prompt").alias("prompt_md5"), "max_new_tokens",
                       F.size(prompt_messages("prompt", "system")).alias("n_messages"))


@query("key_fallback", f"""
WITH {d.PAIRS_SQL}
SELECT row_ord, md5(coalesce(CASE WHEN row_ord % 3 > 0 THEN input END, 'null') || '|' || output) AS kept_md5,
  md5(CASE WHEN row_ord % 3 > 0 THEN input ELSE 'second' END || '|' || output) AS filled_md5, md5('second|') AS named_md5
FROM pairs
""")
def key_fallback(spark: Spark, folder: str) -> DataFrame:
    rows = d.pairs(spark, folder).select(
        "row_ord", F.when(F.col("row_ord") % 3 > 0, F.col("input")).alias("input"), F.lit("second").alias("instruction"),
        F.col("output").alias("response"))

    def md5(df: DataFrame, name: str, **rule) -> DataFrame:
        parts = F.transform("messages", lambda m: F.coalesce(m["content"], F.lit("null")))
        return canonical_pairs(df, keep=("row_ord",), **rule).select("row_ord", F.md5(F.array_join(parts, "|")).alias(name))

    # Without an answer column of either name the answer is empty.
    named = md5(rows.drop("input", "response"), "named_md5")
    return md5(rows, "kept_md5").join(md5(rows, "filled_md5", null_fallback=True), "row_ord").join(named, "row_ord")


@query("pad_default", """
SELECT item_id, md5(array_to_string(list_concat(ids, list_resize([]::INTEGER[], 300 - len(ids), 0)), ',')) AS eos_md5,
  md5(array_to_string(list_concat(ids, list_resize([]::INTEGER[], 300 - len(ids), 9)), ',')) AS given_md5
FROM (SELECT item_id, list_transform(regexp_extract_all(text, '[a-z]')[:300], lambda c: ascii(c)) AS ids FROM benchmark)
""")
def pad_default(spark: Spark, folder: str) -> DataFrame:
    text = F.substring(F.regexp_replace("text", "[^a-z]", ""), 1, 300)
    rows = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", byte_ids(text).alias("ids"))

    def md5(pad: int) -> Column:
        return F.md5(F.array_join(padded("ids", F.lit(300), pad).cast("array<string>"), ","))

    return rows.select("item_id", md5(pad_id(None, 0)).alias("eos_md5"), md5(pad_id(9, 0)).alias("given_md5"))


@query("path_gate", "SELECT 'benchmark' AS name, true AS found, false AS stopped UNION ALL SELECT 'absent', false, true")
def path_gate(spark: Spark, folder: str) -> DataFrame:
    rows = []
    for name in ("benchmark", "absent"):
        path, stopped = f"{folder}/{name}.parquet", False
        try:
            require_path(spark, path)
        except FileNotFoundError:
            stopped = True
        rows.append((name, path_exists(spark, path), stopped))
    return spark.createDataFrame(rows, "name string, found boolean, stopped boolean")


@query("format_numbers", """
SELECT event_id, printf('%.1f', v) AS one, printf('%.2f', v) AS two, format('{:,}', CAST(round_even(v, 0) AS BIGINT)) AS thousands,
  CAST(event_id * 1048576 + 524288 AS DOUBLE) / 1048576.0::DOUBLE AS mb
FROM (SELECT event_id, CAST(floor(value) * 1000 + event_id % 8 AS DOUBLE) / 8 AS v FROM events)
""")
def format_numbers(spark: Spark, folder: str) -> DataFrame:
    value = (F.floor("value") * 1000 + F.col("event_id") % 8).cast("double") / 8
    rows = d.events(spark, folder).select("event_id", value.alias("v"))
    return rows.select("event_id", one_decimal("v").alias("one"), two_decimals("v").alias("two"), thousands("v").alias("thousands"),
                       mebibytes(F.col("event_id") * 1048576 + 524288).alias("mb"))


@query("artifact_reports", f"""
WITH {d.LISTING_SQL},
l AS (SELECT artifact, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes,
  bool_or(name = 'adapter_config.json') AS c, bool_or(name = 'adapter_model.safetensors') AS m FROM listing GROUP BY artifact),
g AS (SELECT 'run-' || (user_id * 3) AS artifact, 'base-' || (user_id % 4) AS base, count(*) AS r FROM events GROUP BY user_id)
SELECT coalesce(l.artifact, g.artifact) AS artifact, coalesce(n_files, 0) AS n_files, total_bytes, g.base AS base_model, CAST(r AS VARCHAR) AS lora_r,
  CASE WHEN coalesce(c, false) THEN '' ELSE 'adapter_config.json' END || '|' || CASE WHEN coalesce(m, false) THEN '' ELSE 'adapter_model.safetensors' END AS missing,
  coalesce(c AND m, false) AS ready
FROM l FULL JOIN g ON g.artifact = l.artifact
""")
def artifact_reports(spark: Spark, folder: str) -> DataFrame:
    configs = d.events(spark, folder).groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("r")).select(
        F.concat(F.lit("run-"), (F.col("user_id") * 3).cast("string")).alias("artifact"),
        F.concat(F.lit("base-"), (F.col("user_id") % 4).cast("string")).alias("base_model_name_or_path"), "r",
        F.lit(None).cast("int").alias("lora_alpha"), F.lit(None).cast("array<string>").alias("target_modules"))
    rows = artifact_report(d.listing(spark, folder), configs)

    def lacks(name: str) -> Column:
        return F.when(F.array_contains("missing", name), name).otherwise("")

    return rows.select("artifact", "n_files", "total_bytes", "base_model", "lora_r",
                       F.concat_ws("|", lacks("adapter_config.json"), lacks("adapter_model.safetensors")).alias("missing"), "ready")
