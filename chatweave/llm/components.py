"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.session import drop_path, scratch_path

# Edges of a graph that one task joins: some 200 bytes each.
LOCAL_EDGES = 300_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(rows: DataFrame) -> DataFrame:
    """Per u the least of u and its neighbours; sums up map-side, so a hub is no hot task."""
    return rows.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a whole small graph to (node, component)."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.types[0]
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    if root:
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], ["node", "component"])


def connected(edges: DataFrame, folder: str | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (u, v), the component being its least node.

    Up to ``LOCAL_EDGES`` edges, counted first, are joined in one task. Beyond that each step shuffles the edges
    twice and writes them below ``folder`` (else in the shared folder), where
    only the last step's are kept; the number of steps grows with the logarithm of the diameter.
    """
    spark = edges.sparkSession
    folder = folder or scratch_path(spark, "stars")
    made = 0

    def _saved(rows: DataFrame) -> DataFrame:
        nonlocal made
        made += 1
        rows.write.parquet(f"{folder}/{made}")
        if made > 1:
            drop_path(spark, f"{folder}/{made - 1}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{made}")

    stars = _saved(edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if stars.count() <= local_edges:
        kind = dict(stars.dtypes)["u"]
        return stars.coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}")
    before = None
    while True:
        near = _both(stars)
        large = (near.join(_least(near), "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        down = large.filter(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = _least(down)
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        stars = _saved(small.filter(F.col("u") != F.col("v")).distinct())
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            roots = stars.select(F.col("v").alias("node")).distinct()
            return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(roots.select("node", F.col("node").alias("component"))))
        before = now
