"""Ranked lexical search with the Best Position Algorithm.

Terms are the runs of letters, digits and all characters beyond ASCII, A-Z in lower case. A
document's score is the sum, over the terms of an item with repeats, of its impact for the
term: ``w * (10**9 * tf div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N+2)/(2df+1)))``
and ``m = 100 - b + (b * n * N div L)``; N counts the documents with a term, L their terms, n
the document's terms. The ``k`` highest scores above 0 are returned, equal ones by ascending id.

Index. One pass over the texts keeps, per document, the terms that any item asks for and their
counts (a table in the shared folder); one aggregate over it gives N, L and df.

Search. A task holds ``postings`` of these at a time as impact lists: per term the documents
by falling impact, and per document its positions in all lists. An item's search reads, by
direct access, the first positions it has not seen in each of its lists (twice as many each
time), scores the documents found there in full, and marks their positions in all lists as
seen. The best position of a list is the last one up to which all are seen, whether they
were reached in this list or through another one; documents not seen yet can reach no more
than the sum of the impacts at the best positions, and nothing from lists that are seen to
their end. The search stops when that sum is strictly below the k-th score, so that equal
scores are never missed. The k best of earlier blocks of a task set the k-th score from the start. Each
task returns at most k rows an item, and a bounded window merges these.

Items are taken in blocks of at most ``ITEM_BYTES`` of text (one item at least), each with its
own pass, so what is broadcast is bounded whatever the number of items.

Defined cases: null text has no terms; a document without terms counts nowhere; items without
terms and items that nothing matches return no rows; rows that repeat an id, of documents
or items, are documents or items of their own; null document ids rank behind others of the same
score; other columns are ignored, whatever their names; an empty table gives an empty
result; texts are used whole, a long one in parts cut between terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatweave.session import scratch_path

PART = 1_000_000
POSTINGS = 2_000_000
ITEM_BYTES = 8_000_000
FIRST_STEP, LAST_STEP = 4, 4096
# Bytes of a term, A-Z as a-z; all others become blanks. Bytes from 128 on belong to characters beyond ASCII.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_parts(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    flat = (text or b"").translate(TERM_BYTES)
    at = 0
    while at < len(flat):
        stop = flat.find(b" ", at + PART)
        stop = len(flat) if stop < 0 else stop
        yield flat[at:stop].split()
        at = stop


def term_counts(text: bytes | None) -> Counter:
    counts: Counter = Counter()
    for part in term_parts(text):
        counts.update(part)
    return counts


@dataclass
class Items:
    """A block of items: ids, and per item its term numbers and their counts."""

    ids: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    numbers: dict[bytes, int]


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """Items in blocks of bounded text; only one block at a time is held."""
    block, held = Items([], [], [], {}), 0
    rows = items.select(F.col(item_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        text = bytes(row["text"] or b"")
        if block.ids and held + len(text) > ITEM_BYTES:
            yield block
            block, held = Items([], [], [], {}), 0
        held += len(text)
        counts = term_counts(text)
        if counts:
            block.ids.append(row["id"])
            block.terms.append(np.array([block.numbers.setdefault(t, len(block.numbers)) for t in counts], np.int64))
            block.times.append(np.array(list(counts.values()), np.int64))
    if block.ids:
        yield block


def _index(numbers):
    """(id, text) to (id, n, terms, times), without documents that have no term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            ns, terms, times = [], [], []
            for text in batch.column(1):
                n, found = 0, Counter()
                for part in term_parts(text.as_py()):
                    n += len(part)
                    for term, count in Counter(part).items():
                        number = known.get(term)
                        if number is not None:
                            found[number] += count
                ns.append(n)
                terms.append(list(found))
                times.append(list(found.values()))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int64()))], ["id", "n", "terms", "times"])
            yield out.filter(pa.array([n > 0 for n in ns], pa.bool_()))

    return run


class Block:
    """Impact lists of some documents, which are numbered in the order of their ids."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        """``starts`` are the first places of the documents in ``terms`` and ``impacts``, and their end."""
        self.starts, self.terms, self.impacts = starts, terms, impacts
        docs = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        order = np.lexsort((-impacts, terms))
        self.listed_docs, self.listed_impacts = docs[order], impacts[order]
        self.places = np.empty(len(order), np.int64)  # of a document's postings in the lists
        self.places[order] = np.arange(len(order))
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The whole scores of documents, and the places of their postings."""
        first, sizes = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1]) - np.repeat(ends - sizes - first, sizes)
        return np.add.reduceat(weight[self.terms[rows]] * self.impacts[rows], ends - sizes), self.places[rows]


def best_positions(block: Block, terms: np.ndarray, times: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents of a block by score, then number, of those that reach ``floor``, their
    scores, and how many documents were looked at."""
    weight = np.zeros(len(block.bounds) - 1, np.int64)
    weight[terms] = times
    first, end = block.bounds[terms], block.bounds[terms + 1]
    unseen_at = first.copy()  # per list the first position not seen
    seen = np.zeros(len(block.places), bool)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    looked, step, least = 0, FIRST_STEP, floor
    while True:
        left = np.flatnonzero(unseen_at < end)
        best = np.maximum(unseen_at[left] - 1, first[left])
        if not len(left) or int((times[left] * block.listed_impacts[best]).sum()) < least:
            return docs, scores, looked
        reached = [at + np.flatnonzero(~seen[at:at + 2 * step])[:step]
                   for at in unseen_at[left].tolist()]
        reached = [r[r < e] for r, e in zip(reached, end[left].tolist(), strict=True)]
        found = np.unique(block.listed_docs[np.concatenate(reached)])
        got, places = block.scores(found, weight)
        seen[places] = True
        looked += len(found)
        docs, scores = np.concatenate([docs, found]), np.concatenate([scores, got])
        keep = scores >= least
        docs, scores = docs[keep], scores[keep]
        order = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[order], scores[order]
        if len(docs) == k:
            least = max(floor, int(scores.min()))
        for i in left.tolist():
            at, stop = int(unseen_at[i]), int(end[i])
            while at < stop:
                some = seen[at:min(stop, at + 4 * step)]
                gap = int(some.argmin())
                if not some[gap]:
                    at += gap
                    break
                at += len(some)
            unseen_at[i] = at
        step = min(2 * step, LAST_STEP)


def _place(ids: list) -> list[int]:
    """The order of ids, nulls last."""
    return sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))


def _search(shared, k: int, b: int, postings: int):
    """(id, n, terms, times) to (number, item, id, score), at most k rows an item and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w, total, length, item_type = shared.value
        best: list[list[tuple]] = [[] for _ in items.ids]  # (-score, id is null, id)
        held: list[pa.RecordBatch] = []
        id_type = None

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column(0).to_pylist()
            order = _place(ids)
            table, ids = table.take(pa.array(order, pa.int64())).combine_chunks(), [ids[i] for i in order]
            lists = [table.column(i).chunk(0) for i in (2, 3)]
            starts = lists[0].offsets.to_numpy().astype(np.int64)
            starts -= starts[0]
            terms, times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            m = np.array([100 - b + b * n * total // length for n in table.column(1).to_pylist()], np.int64)
            impacts = w[terms] * (10**9 * times // (1000 * times + 8 * np.repeat(m, np.diff(starts))))
            block = Block(starts, terms, impacts, len(w))
            for i in range(len(items.ids)):
                floor = max(1, -best[i][-1][0]) if len(best[i]) == k else 1
                docs, scores, _ = best_positions(block, items.terms[i], items.times[i], k, floor)
                if len(docs):
                    new = [(-s, ids[d] is None, ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
                    best[i] = sorted(best[i] + new, key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))[:k]

        size = 0
        for batch in batches:
            id_type = batch.column(0).type
            some = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column(2)), 0))
            if some.num_rows:
                held.append(some)
                size += len(some.column(2).flatten())
            if size >= postings:
                flush()
                held, size = [], 0
        if held:
            flush()
        for i, rows in enumerate(best):
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(rows), pa.int64()), pa.array([items.ids[i]] * len(rows), item_type),
                     pa.array([x[2] for x in rows], id_type), pa.array([-x[0] for x in rows], pa.int64())],
                    ["number", "item", "id", "score"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, b: int = 75, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", postings: int = POSTINGS) -> DataFrame:
    """(``item_col``, rank, ``id_col``, score): the k best documents of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type, item_type = dict(rows.dtypes)["id"], dict(items.dtypes)[item_col]
    arrow_type = items.select(item_col).limit(0).toArrow().schema.field(0).type
    found = []
    for block in item_blocks(items, item_col, item_text_col):
        path = scratch_path(spark, "postings")
        schema = f"id {id_type}, n bigint, terms array<int>, times array<bigint>"
        rows.mapInArrow(_index(spark.sparkContext.broadcast(block.numbers)), schema).write.parquet(path)
        index = spark.read.schema(schema).parquet(path)
        total, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not total:
            continue
        # One row for each term of the block's items.
        df = np.zeros(len(block.numbers), np.int64)
        for term, count in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
            df[term] = count
        w = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        asked = Items(block.ids, block.terms, block.times, {})
        shared = spark.sparkContext.broadcast((asked, w, int(total), int(length), arrow_type))
        hits = index.mapInArrow(_search(shared, k, b, postings), f"number bigint, item {item_type}, id {id_type}, score bigint")
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    if not found:
        return spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} {id_type}, score bigint")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
