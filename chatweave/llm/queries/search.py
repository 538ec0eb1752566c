"""Queries of the searches for benchmark items: by containment and ranked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatweave.llm.decontaminate import find_items
from chatweave.llm.lexical_search import rank_documents
from chatweave.llm.queries.native import ASCII_SPACE, LOWER


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return find_items(docs, items)


def _shingles(table: str, key: str) -> str:
    return f"""
{table}_w AS (SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}),
  '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM {table}),
{table}_s AS (SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS s
  FROM {table}_w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0)"""


OP8_SQL = f"""
WITH {_shingles('documents', 'doc_id')}, {_shingles('benchmark', 'item_id')},
n AS (SELECT item_id, count(*) AS n_item FROM benchmark_s GROUP BY item_id),
m AS (SELECT d.doc_id, b.item_id, count(*) AS n_shared FROM documents_s d JOIN benchmark_s b USING (s)
      GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return rank_documents(docs, items)


def _terms(table: str, key: str) -> str:
    return f"""
{table}_t AS (SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOWER}),
  '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM {table})"""


OP11_SQL = f"""
WITH {_terms('documents', 'doc_id')}, {_terms('benchmark', 'item_id')},
n AS (SELECT doc_id, count(*) AS n FROM documents_t GROUP BY doc_id),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS len FROM n),
q AS (SELECT item_id, term, count(*) AS times FROM benchmark_t GROUP BY ALL),
p AS (SELECT doc_id, term, count(*) AS tf FROM documents_t SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, c GROUP BY term, n_docs),
i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // len))) AS impact
      FROM p JOIN n USING (doc_id) JOIN w USING (term), c),
s AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

QUERIES = {"op8_benchmark_decontamination": op8_benchmark_decontamination,
           "op11_ranked_lexical_search": op11_ranked_lexical_search}
ORACLE = {"op8_benchmark_decontamination": OP8_SQL, "op11_ranked_lexical_search": OP11_SQL}
