"""Benchmark decontamination: size-partitioned MinHash containment search.

A document holds an item when it has at least ``threshold`` of the item's distinct five-word
shingles, however long the document is. Items are partitioned by size, in powers of
two of their shingle count n. The MinHash signature of an item is its lowest
``n - ceil(threshold * n) + 1`` shingle hashes: a document that holds the item misses fewer
shingles than the signature has, so it has one of the signature, and nothing is lost. Documents
with too few shingles for a size partition are not searched for its items. Candidates are
verified on the shingles themselves.

Defined cases: null text is empty; a text of fewer than five words is one shingle, so a short
item is found only in documents of the same words; blank items are never found; repeated
items are searched each; rows that repeat an id are searched each; null ids are found like others;
empty tables give no rows; extra columns are ignored by the search and kept by the filter.

Texts are read once, shingle hashes meet the signatures in a hash join (broadcast up to
``BROADCAST_ROWS`` signature rows and ``BROADCAST_BYTES`` of the texts they carry, both counted first), and only candidates' texts are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatweave.llm.columns import let, row_key, shingle_hashes, words

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64_000_000


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct runs of ``size`` words as strings; fewer words are one run, none give none."""
    return let(words(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>"))
               .when(F.size(w) < size, F.array(F.array_join(w, " ")))
               .otherwise(F.array_distinct(F.transform(
                   F.sequence(F.lit(1), F.size(w) - size + 1),
                   lambda i: F.array_join(F.slice(w, i, F.lit(size)), " ")))))


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """One row per item and signature hash, with the size partition and its least item size."""
    sized = items.select("item", F.array_distinct(shingle_hashes(F.col("text"))).alias("h")).filter(F.size("h") > 0)
    n = F.size("h")
    length = n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1
    part = F.floor(F.log2(n)).cast("int")
    return sized.select("item", part.alias("part"), F.pow(F.lit(2.0), part).alias("least"),
                        F.explode(F.slice(F.array_sort("h"), F.lit(1), length)).alias("hash"))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """Pairs (id, item, n_item, n_shared, containment) of at least ``threshold``."""
    # Rows meet by id and text, so that null or repeated ids are no group.
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                      row_key(id_col, text_col).alias("at"))
    asked = items.select(F.struct(F.col(item_col).alias("key"), F.coalesce(
        F.col(item_text), F.lit("")).alias("text")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    sig = signatures(asked, threshold)
    n_rows, n_bytes = sig.agg(F.count(F.lit(1)), F.sum(F.octet_length("item.text").cast("bigint"))).first()
    if n_rows <= BROADCAST_ROWS and (n_bytes or 0) <= BROADCAST_BYTES:
        sig = F.broadcast(sig)

    hashed = own.select("at", F.array_distinct(shingle_hashes(F.col("t"))).alias("h"))
    single = hashed.select("at", F.size("h").alias("n"), F.explode("h").alias("hash"))
    met = single.join(sig, "hash").filter(F.col("n") >= F.col("least") * threshold)
    found = met.groupBy("at").agg(F.collect_set("item").alias("items")).withColumnRenamed("at", "found")

    pairs = (own.join(found, F.col("at") == F.col("found"))
             .select("id", shingles(F.col("t")).alias("has"), "items")
             .select("id", F.explode(F.transform("items", lambda i: let(
                 shingles(i["text"]), lambda s: F.struct(
                     i["key"].alias("item"), F.size(s).cast("bigint").alias("n_item"),
                     F.size(F.array_intersect(s, F.col("has"))).cast("bigint").alias("n_shared"))))).alias("p")))
    return (pairs.select(F.col("id").alias(id_col), F.col("p.item").alias(item_col), "p.n_item", "p.n_shared",
                         (F.col("p.n_shared") / F.col("p.n_item")).alias("containment"))
            .filter(F.col("n_shared") >= F.col("n_item") * threshold - 1e-9))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **kw) -> DataFrame:
    """``docs`` without the rows that hold an item; other rows of the same id stay."""
    # Apart from the row itself only helper names, so that no input column can clash.
    keyed = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    hit = find_items(keyed, items, "key", "text", **kw).select(F.col("key").alias("hit")).distinct()
    return keyed.join(hit, F.col("key") == F.col("hit"), "left_anti").select("row.*")
