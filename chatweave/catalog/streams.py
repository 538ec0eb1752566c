"""Streams run to their end over files derived from the tables.

Each must give what its batch counterpart gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.catalog.sessions import CONTEXT_SQL, SPAN, context_report
from chatweave.operators.sessions import idle_contexts
from chatweave.operators.text_stream import accumulate_tokens
from chatweave.session import scratch_path
from chatweave.streaming import readers
from chatweave.streaming.run import run_to_end
from chatweave.streaming.state import chat_contexts, responses
from chatweave.streaming.telemetry import memory_peaks

Spark = SparkSession

# Tokens: words with the blanks after them.
TOKENS_SQL = r"regexp_extract_all(text, '[^ ]+ *| +')"

TEXTS_SQL = f"""
SELECT conv_id, turn, md5(text) AS text_md5, CAST(len({TOKENS_SQL}) AS BIGINT) AS n_tokens
FROM conversations
"""


def token_rows(spark: Spark, folder: str) -> DataFrame:
    rows = d.conversations(spark, folder).select(
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.regexp_extract_all("text", F.lit(r"[^ ]+ *| +"), F.lit(0)).alias("t"),
    )
    items = rows.select("id", F.size("t").alias("n"), F.posexplode_outer("t").alias("seq", "token"))
    return items.filter(F.col("seq").isNotNull()).select("id", "seq", "token", (F.col("seq") == F.col("n") - 1).alias("is_last"))


def _texts(df: DataFrame, *more: str) -> DataFrame:
    conv_id, turn = (F.split("id", ":")[i].cast("bigint") for i in (0, 1))
    return df.select(conv_id.alias("conv_id"), turn.alias("turn"), F.md5("text").alias("text_md5"), "n_tokens", *more)


@query("token_accumulate", TEXTS_SQL)
def token_accumulate(spark: Spark, folder: str) -> DataFrame:
    # Small parts, so that most texts have several.
    return _texts(accumulate_tokens(token_rows(spark, folder), part_size=16))


# Responses of a bucket of the state, and of a part of the files; the number of micro-batches is fixed.
BUCKET, FILE = 512, 50_000


def _dealt(spark: Spark, folder: str) -> tuple[int, int]:
    """Buckets of the state, and how many times the least number of files are written, both in proportion to the input."""
    n = d.conversations(spark, folder).count()
    return 1 + n // BUCKET, 1 + n // FILE


@query("stream_responses", TEXTS_SQL)
def stream_responses(spark: Spark, folder: str) -> DataFrame:
    root = scratch_path(spark, "tokens")
    buckets, files = _dealt(spark, folder)
    # Files cut texts at any place: tokens of a text come in different micro-batches.
    token_rows(spark, folder).repartition(8 * files, "id", "seq").write.parquet(f"{root}/in")
    stream = responses(readers.token_rows(spark, f"{root}/in", 4 * files, id_type="string"), buckets=buckets)
    return _texts(run_to_end(spark, stream, f"{root}/out", f"{root}/state"))


# Some short words stand for special tokens; odd messages never get their last token.
SPECIALS = ("the ", "of ", "de ", "la ", "die ", "en ")

SPECIALS_SQL = f"""
SELECT conv_id, turn, md5(array_to_string(list_filter(t, lambda x: x NOT IN {SPECIALS}), '')) AS text_md5,
  CAST(len(t) AS BIGINT) AS n_tokens, turn % 2 = 0 AS complete
FROM (SELECT conv_id, turn, {TOKENS_SQL} AS w, CASE WHEN turn % 2 = 0 THEN w ELSE w[:-2] END AS t FROM conversations)
WHERE len(t) > 0
"""


@query("stream_tokens", SPECIALS_SQL)
def stream_tokens(spark: Spark, folder: str) -> DataFrame:
    """Repeated and special tokens, tokens that are late, responses that never end."""
    root = scratch_path(spark, "tokens")
    rows = token_rows(spark, folder).withColumn("at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seq")))
    rows = rows.filter(~(F.col("is_last") & (F.split("id", ":")[1].cast("bigint") % 2 == 1)))
    half = F.pmod(F.xxhash64("id", "seq"), F.lit(2))
    buckets, files = _dealt(spark, folder)

    def go(more: DataFrame) -> DataFrame:
        more.write.mode("append").parquet(f"{root}/in")
        stream = responses(readers.token_rows(spark, f"{root}/in", 2 * files, "string", at="at"), SPECIALS, "at", "2 days", "1 hour", buckets)
        return run_to_end(spark, stream, f"{root}/out", f"{root}/state")

    go(rows.filter(half == 0).repartition(4 * files, "id", "seq"))
    # All tokens, so half of them a second time.
    go(rows.repartition(4 * files, "id", "seq"))
    # A token far ahead moves the watermark past all that is open.
    ahead = spark.range(1).select(F.lit("-1:0").alias("id"), F.lit(0).alias("seq"), F.lit("x").alias("token"), F.lit(False).alias("is_last"))
    go(ahead.withColumn("at", F.lit("2030-01-01 00:00:00").cast("timestamp")))
    found = go(rows.withColumn("token", F.lit("late")).repartition(2 * files, "id"))
    return _texts(found, "complete")


def _replay(spark: Spark, parts: list[DataFrame], delay: str, idle: str) -> DataFrame:
    """Contexts of inputs that are written and read one part after the other, with a restart after each."""
    root = scratch_path(spark, "inputs")
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/in/part={i}")
        stream = chat_contexts(readers.session_inputs(spark, f"{root}/in/*", 2, at="at"), at="at", delay=delay, idle=idle)
        found = run_to_end(spark, stream, f"{root}/out", f"{root}/state")
    return found


def _last_input(spark: Spark) -> DataFrame:
    """An input far ahead, which moves the watermark past all others."""
    return spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("/exit").alias("text"),
        F.lit(None).cast("string").alias("reply"), F.lit("2100-01-01 00:00:00").cast("timestamp").alias("at"))


@query("stream_contexts", CONTEXT_SQL)
def stream_contexts(spark: Spark, folder: str) -> DataFrame:
    inputs = d.input_times(d.session_inputs(spark, folder))
    # Files in any order: each holds rows of all sessions and times.
    parts = [inputs.filter(F.pmod(F.xxhash64("turn", "conv_id"), F.lit(2)) == i).repartition(4, "turn") for i in (0, 1)]
    return context_report(_replay(spark, [*parts, _last_input(spark)], "10000 days", "10000 days"))


IDLE_SQL = CONTEXT_SQL.replace("u.conv_id // 10 AS conv_id", "u.conv_id // 10 * 4 + u.conv_id % 10 // 3 AS conv_id").replace(
    "SELECT t.conv_id, t.turn,\n  CAST", "SELECT t.conv_id // 4 AS conv_id, t.turn,\n  CAST")


@query("idle_contexts", IDLE_SQL)
def idle_batch(spark: Spark, folder: str) -> DataFrame:
    inputs = d.input_times(d.session_inputs(spark, folder), pause=120)
    return context_report(idle_contexts(inputs, "at", "100 minutes", span=SPAN))


@query("stream_sessions", IDLE_SQL)
def stream_sessions(spark: Spark, folder: str) -> DataFrame:
    """Sessions that go idle, with inputs that are repeated, out of order, or late."""
    inputs = d.input_times(d.session_inputs(spark, folder), pause=120)
    half = inputs.filter(F.pmod(F.xxhash64("turn", "conv_id"), F.lit(2)) == 0)
    late = inputs.withColumn("text", F.lit("late"))
    parts = [half.repartition(4, "turn"), inputs.repartition(4, "turn"), _last_input(spark), late.repartition(2, "turn")]
    return context_report(_replay(spark, parts, "1000 days", "100 minutes"))


PEAKS_SQL = f"""
WITH {d.LINES_SQL},
m AS (
  SELECT ingest_ts, regexp_extract(line, '^\\[Rank (\\d+)\\] \\[MEM:([^\\]]*)\\] (RAM|GPU\\d+): ([\\d,]+)MB / ([\\d,]+)MB',
    ['rank', 'label', 'device', 'used', 'total']) AS x
  FROM lines WHERE line LIKE '%[MEM:%')
SELECT CAST(epoch(date_trunc('day', ingest_ts)) AS BIGINT) AS day_start, CAST(x.rank AS INTEGER) AS rank, x.label AS label,
  x.device AS device, max(CAST(replace(x.used, ',', '') AS BIGINT)) AS peak_mb,
  arg_max(CAST(replace(x.used, ',', '') AS BIGINT), (ingest_ts, CAST(replace(x.used, ',', '') AS BIGINT))) AS last_mb,
  count(*) AS n_lines
FROM m GROUP BY 1, 2, 3, 4
"""


def _peaks(df: DataFrame) -> DataFrame:
    return df.select(
        F.unix_timestamp("window_start").alias("day_start"), "rank", "label", "device", "peak_mb", "last_mb", "n_lines"
    )


@query("memory_peaks", PEAKS_SQL)
def batch_peaks(spark: Spark, folder: str) -> DataFrame:
    return _peaks(memory_peaks(d.memory_lines(spark, folder), "1 day", delay=None))


@query("stream_memory_peaks", PEAKS_SQL)
def stream_peaks(spark: Spark, folder: str) -> DataFrame:
    root = scratch_path(spark, "lines")
    lines = d.memory_lines(spark, folder)
    lines.repartition(4).write.parquet(f"{root}/in")
    # A closing line far in the future moves the watermark past the last window.
    last = lines.agg((F.max("ingest_ts") + F.expr("INTERVAL 90 DAYS")).alias("ingest_ts"))
    last.withColumn("line", F.lit("[Rank 0] [MEM:END] GPU0: 0MB / 0MB")).write.mode("append").parquet(f"{root}/in")
    stream = memory_peaks(readers.telemetry_lines(spark, f"{root}/in"), "1 day", delay="40 days")
    out = run_to_end(spark, stream, f"{root}/out", f"{root}/state")
    return _peaks(out).filter(F.col("label") != "END")
