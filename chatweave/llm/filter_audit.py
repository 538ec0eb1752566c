"""Audit of how filters interact, kept up to date by a stream with retractions.

Every document fails some of a row of filters. The audit tells, for every order in which the
filters can be applied and each step, how many documents a part of the corpus keeps and loses there, and
what of the loss is good, toxic, redundant, or due to this filter alone.

The duplicate filter ``E`` fails documents whose text a smaller id has anywhere in the
table. A stream can't know this when a document comes: the smallest id may arrive last. All
files are taken as available-now micro-batches, and the state keeps per text (under its
SHA-256) the smallest id so far with the parts of its rows. A row with a larger id fails ``E`` for good. When a
smaller id arrives, the rows of the earlier smallest id are retracted: one event of -1 under
the mask they had, one of +1 under the mask with ``E``. The part counters are the sums of
these events, per part and mask of failed filters, so at any time they are those of the files read so far. With a
``work`` folder of the caller's, a later call reads only new files and goes on from there.

How it runs: masks and digests are Spark expressions at the scan. Before the shuffle each
batch of rows finds its smallest id per text; only rows of that id are asked of the state, and all
others go as one group per batch, so a text that a third of the rows share sends one row per batch to its
state. Texts are dealt to buckets of ``BUCKET`` or so, as many as the first files ask for, and a bucket's
texts are one row of state, some 50 bytes a text, checkpointed in the shared folder. State is kept by the
provider that the session names (``spark.sql.streaming.stateStore.providerClass``): Spark's own one holds it in
the executors' memory, RocksDB on their disks, which a corpus of billions of texts asks for. Events
are written by the stream's file sink (exactly once), and one join by id adds the labels.
A part has at most one counter per mask, and the table of orders and steps is
computed from these.

Defined cases: null text is empty; null parts are the empty string; a null id is larger than all others, and
equal to itself; rows of the same id and text are not duplicates of each other (they fail ``E`` together or not at all); an id's labels count if any
of its label rows has them; label rows without a document count nowhere; other columns are ignored,
whatever their names; texts are used whole; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.llm.columns import SPACE, SPACES, UPPER, let
from chatweave.session import scratch_path
from chatweave.sources.tables import path_exists
from chatweave.streaming.run import run_to_end

DUPLICATE = "E"
ROWS = "sure boolean, bucket bigint, key binary, id string, part string, mask int, n bigint"
EVENTS = "id string, part string, mask int, delta bigint"
STATE = "texts binary"
BUCKET = 512


def word_counts(text: Column) -> Column:
    """A struct of the numbers of words and of different words between ASCII white space."""
    return let(F.btrim(text, F.lit(SPACE)), lambda t: let(
        F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACES, -1)),
        lambda w: F.struct(F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct"))))


def failures() -> dict[str, Column]:
    """The filters that look at one text: the condition under which ``text`` fails each, given ``counts`` of its words."""
    text, words = F.col("text"), F.col("counts.words")
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": words < 50,
        "B": 100 * F.col("counts.distinct") < 65 * words,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _order(value: str | None) -> tuple:
    """Ids, as texts, in order of their numbers, null last."""
    return (1, 0) if value is None else (0, int(value))


def _first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, key, id, part, mask) to ``ROWS``: rows with a larger id than another row of the batch
    with their text are sure, and grouped under one bucket for the batch; equal rows are counted."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = Counter(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        least: dict[bytes, tuple] = {}
        for _, key, value, _, _ in rows:
            at = _order(value)
            if key not in least or at < least[key]:
                least[key] = at
        # The same for the same rows, so that a task that runs again sends the same groups.
        common = next(int.from_bytes(key[:7], "little") for _, key, _, _, _ in rows)
        sure = [_order(value) > least[key] for _, key, value, _, _ in rows]
        buckets, keys, ids, parts, masks = zip(*rows, strict=True)
        buckets = [common if s else b for s, b in zip(sure, buckets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sure), pa.array(buckets, pa.int64()), pa.array(keys, pa.binary()), pa.array(ids, pa.string()), pa.array(parts, pa.string()),
             pa.array(masks, pa.int32()), pa.array(list(rows.values()), pa.int64())], ["sure", "bucket", "key", "id", "part", "mask", "n"])


def _least_ids(group, batches: Iterator[pd.DataFrame], state, bit: int) -> Iterator[pd.DataFrame]:
    """Events of the texts of a bucket. Its state holds per text the smallest id and the parts of its
    rows, with their numbers; these rows have the mask as it is."""
    columns = ["id", "part", "mask", "delta"]
    if group[0]:
        for rows in batches:
            yield rows.assign(mask=rows["mask"] | bit).rename(columns={"n": "delta"})[columns]
        return
    texts: dict[bytes, tuple] = pickle.loads(state.get[0]) if state.exists else {}
    events: list[tuple] = []
    for rows in batches:
        for key, value, part, mask, n in zip(*(rows[c].tolist() for c in ("key", "id", "part", "mask", "n")), strict=True):
            value, part = None if pd.isna(value) else value, sys.intern(part)
            least, held = texts.get(key, (None, None))
            if held is not None and _order(value) > _order(least):
                events.append((value, part, mask | bit, n))
                continue
            if held is not None and _order(value) < _order(least):
                for old, m in held:
                    events += [(least, old, mask, -m), (least, old, mask | bit, m)]
                held = None
            counts = dict(held or ())
            counts[part] = counts.get(part, 0) + n
            texts[key] = (value, tuple(counts.items()))
            events.append((value, part, mask, n))
    state.update((pickle.dumps(texts, 5),))
    yield pd.DataFrame(events, columns=columns)


def mask_events(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Events (id, part, mask, delta) of a stream of documents; bit i of a mask stands for filter i."""
    # Ids go as texts, as pandas has no integers beside nulls.
    rows = docs.select(F.col(id_col).cast("bigint").cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(part_col), F.lit("")).alias("part"))
    mask = F.lit(0)
    for i, fails in enumerate(failures().values()):
        mask = mask + F.when(fails, 1 << i).otherwise(0)
    masked = rows.withColumn("counts", word_counts(F.col("text"))).select(
        F.unhex(F.sha2("text", 256)).alias("key"), "id", "part", mask.alias("mask"))
    keyed = masked.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", "id", "part", "mask")
    events = keyed.mapInArrow(_first_of_batch, ROWS).groupBy("sure", "bucket").applyInPandasWithState(
        partial(_least_ids, bit=1 << len(failures())), EVENTS, STATE, "append", "NoTimeout")
    return events.withColumn("id", F.col("id").cast("bigint"))


def read_in_batches(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """A stream of the Parquet files at ``path``, dealt to about ``batches`` micro-batches."""
    given = spark.read.parquet(path)
    files = max(1, -(-len(given.inputFiles()) // batches))
    # As a pattern, the path may also name a single file.
    pattern = path.rstrip("/")
    pattern = f"{pattern[:-1]}[{pattern[-1]}]" if pattern[-1].isalnum() else pattern
    return spark.readStream.schema(given.schema).option("maxFilesPerTrigger", files).parquet(pattern)


def counters(events: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): the sums of all events, and of those of labelled documents."""
    told = labels.select(F.col(id_col).cast("bigint").alias("id"), (F.col("quality") == 1).cast("int").alias("good"),
                         (F.col("toxic") == 1).cast("int").alias("toxic"))
    told = (told.filter(F.col("id").isNotNull() & ((F.col("good") == 1) | (F.col("toxic") == 1)))
            .groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    known = events.filter(F.col("id").isNotNull()).join(told, "id", "left").select("part", "mask", "delta", "good", "toxic")
    blank = events.filter(F.col("id").isNull()).select("part", "mask", "delta", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(blank).groupBy("part", "mask").agg(
        F.sum("delta").alias("n"), *[F.sum(F.col("delta") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def steps(letters: str) -> list[dict]:
    """All orders of the filters, step by step, with the filters before each."""
    return [{"filter_order": "".join(order), "step": i + 1, "filter": letter, "bit": 1 << letters.index(letter),
             "before": sum(1 << letters.index(x) for x in order[:i])}
            for order in permutations(letters) for i, letter in enumerate(order)]


def order_report(counts: DataFrame) -> DataFrame:
    """Per part, order and step the counts of documents, from the part counters."""
    letters = "".join([*failures(), DUPLICATE])
    kind = "array<struct<filter_order:string,step:int,filter:string,bit:int,before:int>>"
    each = F.explode(F.from_json(F.lit(json.dumps(steps(letters))), kind))
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = cells.select("part", "cells", each.alias("s")).select("part", "cells", "s.*")
    bit, before = F.col("bit"), F.col("before")

    def total(holds, value=lambda c: c["n"]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + F.when(holds(c["mask"]), value(c)).otherwise(0))

    def has(mask: Column, bits: Column) -> Column:
        return mask.bitwiseAND(bits) != 0

    def fails_here(m: Column) -> Column:
        return has(m, bit) & ~has(m, before)

    orders = math.factorial(len(letters))
    return rows.select(
        "part", "filter_order", "step", "filter",
        total(lambda m: ~has(m, bit.bitwiseOR(before))).alias("kept"),
        total(fails_here).alias("removed"),
        total(lambda m: has(m, bit) & has(m, before)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(fails_here, lambda c: c["good"]).alias("good_lost"),
        total(fails_here, lambda c: c["toxic"]).alias("toxic_lost"),
        # Of all orders, the filter comes first among those that a document fails in this share.
        total(lambda m: has(m, bit), lambda c: (
            c["n"] * F.lit(orders) / F.bit_count(c["mask"])).cast("bigint")).alias("shapley"))


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source", batches: int = 4, work: str | None = None) -> DataFrame:
    """Read all files at ``path`` that ``work`` (state and events) does not know yet, and report on all known."""
    work = work or scratch_path(spark, "filter-audit")
    layout = f"{work}/layout"
    if not path_exists(spark, f"{layout}/_SUCCESS"):  # as many buckets as the first files ask for, for good
        buckets = spark.read.parquet(path).agg(F.ceil((F.count(F.lit(1)) + 1) / BUCKET).cast("int").alias("buckets"))
        buckets.write.mode("overwrite").parquet(layout)
    buckets = spark.read.parquet(layout).first()["buckets"]
    stream = mask_events(read_in_batches(spark, path, batches), buckets, id_col, text_col, part_col)
    events = run_to_end(spark, stream, f"{work}/events", f"{work}/state", rocksdb=False)
    return order_report(counters(events, labels, id_col))
