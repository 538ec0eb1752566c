"""Pieces, vocabularies and token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.catalog import derived as d
from chatweave.catalog import query
from chatweave.functions.tokens import byte_ids, new_tokens, pieces, truncate
from chatweave.operators import lengths
from chatweave.operators.vocabulary import (
    SPECIALS,
    UNK_ID,
    decode,
    encode,
    fit_vocabulary,
)
from chatweave.plans.prepare import encoded_rows
from chatweave.session import scratch_path, spread

Spark = SparkSession

VOCAB_SIZE = 2000


def _pieces(spark: Spark, folder: str) -> DataFrame:
    docs = spread(d.documents(spark, folder).select("doc_id", "lang", "text"), "doc_id")
    return docs.select("doc_id", "lang", pieces("text").alias("p"))


def _vocabulary(spark: Spark, folder: str) -> DataFrame:
    return fit_vocabulary(_pieces(spark, folder), "p", VOCAB_SIZE)


def _joined(ids: Column | str) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(ids.cast("array<string>"), ",")


VOCAB_SQL = f"""
pieces AS (
  SELECT doc_id, lang, regexp_extract_all(text, {d.PIECES_SQL}) AS p FROM documents),
exploded AS (
  SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS pos FROM pieces),
counted AS (SELECT piece, count(*) AS n FROM exploded GROUP BY piece),
vocab AS (
  SELECT piece, CAST(row_number() OVER (ORDER BY n DESC, piece) + {len(SPECIALS) - 1} AS INTEGER) AS id, n
  FROM counted ORDER BY n DESC, piece LIMIT {VOCAB_SIZE})
"""

ENCODED_SQL = f"""
{VOCAB_SQL},
coded AS (
  SELECT e.doc_id, e.pos, e.piece, coalesce(v.id, {UNK_ID}) AS id, v.piece AS known
  FROM exploded e LEFT JOIN vocab v ON v.piece = e.piece),
encoded AS (
  SELECT p.doc_id, coalesce(c.ids, []) AS ids, coalesce(c.text, '') AS text, coalesce(c.n_unk, 0) AS n_unk
  FROM pieces p LEFT JOIN (
    SELECT doc_id, list(id ORDER BY pos) AS ids, string_agg(known, ' ' ORDER BY pos) AS text,
      count(*) FILTER (WHERE id = {UNK_ID}) AS n_unk
    FROM coded GROUP BY doc_id) c ON c.doc_id = p.doc_id)
"""


@query("byte_tokens", """
WITH b AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(text), '..'),
    lambda h: 16 * (strpos('0123456789ABCDEF', h[1]) - 1) + strpos('0123456789ABCDEF', h[2]) - 1) AS ids
  FROM documents)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM b
""")
def byte_tokens(spark: Spark, folder: str) -> DataFrame:
    docs = spread(d.documents(spark, folder).select("doc_id", "text"), "doc_id")
    coded = docs.select("doc_id", byte_ids("text").alias("ids"))
    return coded.select("doc_id", F.size("ids").alias("n_ids"), F.md5(_joined("ids")).alias("ids_md5"))


@query("vocab_fit", f"WITH {VOCAB_SQL} SELECT piece, id, n FROM vocab")
def vocab_fit(spark: Spark, folder: str) -> DataFrame:
    return _vocabulary(spark, folder)


def _encode_report(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").alias("n_tokens"),
        (F.size("ids") - F.size(F.array_remove("ids", UNK_ID))).cast("long").alias("n_unk"),
        F.md5(_joined("ids")).alias("ids_md5"),
    )


ENCODE_REPORT_SQL = f"""
WITH {ENCODED_SQL}
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, n_unk, md5(array_to_string(ids, ',')) AS ids_md5
FROM encoded
"""


@query("encode_vocab", ENCODE_REPORT_SQL)
def encode_vocab(spark: Spark, folder: str) -> DataFrame:
    return _encode_report(encode(_pieces(spark, folder), "doc_id", "p", _vocabulary(spark, folder), "ids"))


@query("encode_vocab_join", ENCODE_REPORT_SQL)
def encode_vocab_join(spark: Spark, folder: str) -> DataFrame:
    # The route for vocabularies too large to ship.
    coded = encode(_pieces(spark, folder), "doc_id", "p", _vocabulary(spark, folder), "ids", limit=0)
    return _encode_report(coded)


@query("truncate_tokens", f"""
WITH {ENCODED_SQL}
SELECT doc_id, CAST(least(len(ids), 2048) AS INTEGER) AS n_prepare, CAST(least(len(ids), 1024) AS INTEGER) AS n_train,
  md5(array_to_string(ids[1:1024], ',')) AS train_md5, CAST(least(len(ids), 2048) AS BIGINT) AS mask_sum
FROM encoded
""")
def truncate_tokens(spark: Spark, folder: str) -> DataFrame:
    docs = spread(d.documents(spark, folder).select("doc_id", "text"), "doc_id")
    rows = encoded_rows(docs, _vocabulary(spark, folder), "doc_id")
    train = truncate("input_ids", 2048, 1024)
    return rows.select(
        "doc_id", F.size("input_ids").alias("n_prepare"), F.size(train).alias("n_train"),
        F.md5(_joined(train)).alias("train_md5"),
        F.size(F.array_remove("attention_mask", 0)).cast("long").alias("mask_sum"),
    )


@query("decode_tokens", f"WITH {ENCODED_SQL} SELECT doc_id, md5(text) AS text_md5 FROM encoded")
def decode_tokens(spark: Spark, folder: str) -> DataFrame:
    vocab = _vocabulary(spark, folder)
    coded = encode(_pieces(spark, folder), "doc_id", "p", vocab, "ids").select("doc_id", "ids")
    return decode(coded, "doc_id", "ids", vocab).select("doc_id", F.md5("text").alias("text_md5"))


@query("decode_tokens_join", f"WITH {ENCODED_SQL} SELECT doc_id, md5(text) AS text_md5 FROM encoded")
def decode_tokens_join(spark: Spark, folder: str) -> DataFrame:
    vocab = _vocabulary(spark, folder)
    coded = encode(_pieces(spark, folder), "doc_id", "p", vocab, "ids").select("doc_id", "ids")
    return decode(coded, "doc_id", "ids", vocab, limit=0).select("doc_id", F.md5("text").alias("text_md5"))


@query("new_token_slice", f"""
WITH {d.PAIRS_SQL},
cut AS (
  SELECT row_ord, len(regexp_extract_all(input, {d.PIECES_SQL})) AS n_in,
    regexp_extract_all(output, {d.PIECES_SQL}) AS o FROM pairs)
SELECT row_ord, CAST(n_in AS INTEGER) AS n_in, CAST(len(o) AS INTEGER) AS n_new,
  md5(array_to_string(o, ' ')) AS new_md5
FROM cut
""")
def new_token_slice(spark: Spark, folder: str) -> DataFrame:
    rows = d.pairs(spark, folder).select("row_ord", pieces("input").alias("i"), pieces("output").alias("o"))
    full = rows.select("row_ord", F.size("i").alias("n_in"), F.concat("i", "o").alias("all"))
    new = new_tokens("all", "n_in")
    return full.select("row_ord", "n_in", F.size(new).alias("n_new"), F.md5(F.array_join(new, " ")).alias("new_md5"))


@query("length_stats", f"""
WITH {VOCAB_SQL},
sizes AS (SELECT lang, len(p) AS n FROM pieces),
distinct_pieces AS (
  SELECT p.lang, count(DISTINCT e.piece) AS n_distinct FROM exploded e JOIN pieces p ON p.doc_id = e.doc_id
  GROUP BY p.lang)
SELECT s.lang, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens, CAST(max(n) AS INTEGER) AS longest,
  quantile_cont(CAST(n AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(n AS DOUBLE), 0.9) AS p90, any_value(n_distinct) AS n_distinct
FROM sizes s JOIN distinct_pieces q ON q.lang = s.lang GROUP BY s.lang
""")
def length_stats(spark: Spark, folder: str) -> DataFrame:
    return lengths.length_stats(_pieces(spark, folder), "lang", "p")


@query("length_sketches", f"""
WITH {VOCAB_SQL}
SELECT lang, count(*) AS n_docs, CAST(sum(len(p)) AS BIGINT) AS n_tokens, CAST(max(len(p)) AS INTEGER) AS longest, true AS near
FROM pieces GROUP BY lang
""")
def length_sketches(spark: Spark, folder: str) -> DataFrame:
    """Sketches per language and source, stored, merged per language, and held against the exact rows."""
    docs = spread(d.documents(spark, folder).select("doc_id", "lang", "source", "text"), "doc_id")
    rows = docs.select("doc_id", "lang", "source", pieces("text").alias("p"))
    path = scratch_path(spark, "length-sketches")
    lengths.length_sketches(rows, ["lang", "source"], "p").write.parquet(path)
    merged = lengths.merge_sketches(spark.read.parquet(path), "lang")
    # Of the rows of a language, the share below each sketched quantile; distinct pieces by their ratio.
    asked = rows.select("lang", F.size("p").alias("n")).join(merged, "lang")
    shares = asked.groupBy("lang").agg(*[
        (F.count_if(F.col("n") < F.col(q)) / F.count(F.lit(1))).alias(f"below_{q}") for q in ("p50", "p90")], *[
        (F.count_if(F.col("n") <= F.col(q)) / F.count(F.lit(1))).alias(f"upto_{q}") for q in ("p50", "p90")])
    exact = lengths.length_stats(rows, "lang", "p").select("lang", F.col("n_distinct").alias("known"))
    near = F.abs(F.col("n_distinct") / F.col("known") - 1) < 0.05
    for q, at in (("p50", 0.5), ("p90", 0.9)):
        near = near & (F.col(f"below_{q}") <= at + 0.02) & (F.col(f"upto_{q}") >= at - 0.02)
    return merged.join(shares, "lang").join(exact, "lang").select("lang", "n_docs", "n_tokens", "longest", near.alias("near"))
