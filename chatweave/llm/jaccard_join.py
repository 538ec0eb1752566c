"""N-gram Jaccard join with parity sketches.

A document's set is its distinct five-word shingles, as 64-bit hashes. Two documents link
when ``100 * intersection >= threshold * union``; the result is the connected groups of links.

Sketches. Sets of one size band (sizes from ``4**j`` up to ``4**(j+1)``) are hashed into
the same number of cells, four for each shingle that the band allows; a cell holds the XOR
of its shingles. Each shingle that only one of
two sets has changes one cell, so the number of unequal cells is at most the symmetric
difference. For a link the difference is at most ``(|A|+|B|)/9`` (threshold 80), which is at
most a quarter of either set: by the pigeonhole principle the first k cells that A and B have in
common, in any order that is the same for all documents, are among the first ``|A|/4 + k``
filled cells of A, and likewise of B. These cells are the join keys. k is a tenth of the set, and a document that
shares fewer of its keys with any others has no link and goes no further. A set near the upper end of its band
also joins the next band, where partners of up to 5/4 its size are. A second
sketch of the same kind, with one bit a cell and two bits for each shingle that the band allows,
bounds the difference of a pair before its sets are fetched.

Order of cells. Passages that many documents share would make hot keys. Cells that hold only
frequent shingles come last; the rest is ordered by hash. The list of frequent shingles (at most
``FREQUENT``, by count over the whole table) only sets this order and loses nothing.

Groups. Documents of equal sets are one class and only classes are joined. First every class looks at
the smallest class of each of its keys; the one it meets most often is verified on the whole sets, and keys whose
classes are all in one group are left out. This brings together groups of near copies with one edge per class. Then
pairs that meet under keys of at most ``FEW`` classes are counted, less than ``FEW`` for each row of a key. A pair that
shares only such keys and is a link shares as many of them as either class needs; pairs with so many are verified,
those of each class with the most common keys first, until all are verified or in one group. Any other pair shares a
key of more classes. Of these keys, those with equal sets of
classes are one bucket. Within a bucket (in blocks of ``BLOCK`` classes, each pair of blocks
once), the best few pairs of each class that the sketches allow and that are not yet in one group
are verified; those that
hold join groups. This repeats, with four times as many pairs of each class every time, until no bucket has an allowed pair between two
groups that has not been verified, so no link between different texts is lost. Pairs are kept for the
best few partners of a class only, never for a whole group.

Words are hashed with a multiplier of its own for each place, and long ones by a strong hash, so that no
pattern of letters makes different words meet; a set is known by 128 bits of its shingles.

Defined cases: null text and text without words have an empty set, link with nothing and are
groups of their own, also among each other; fewer than five words are one shingle;
repeated rows are equal texts; a group of rows with null ids only has a null group id; ids
may repeat; an empty table gives an empty table; extra columns are ignored; texts are used whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatweave.llm.components import connected
from chatweave.llm.frequent import most_frequent
from chatweave.llm.hashing import CODES, TURN, chunk_hashes, mix
from chatweave.llm.kept import let_go
from chatweave.session import drop_path, scratch_path, small_batches

SIZE = 5
SLICE = 256
PART = 250_000
FREQUENT = 100_000
COUNTED = 2_000_000
FEW = 32
BLOCK = 4096
BITMAP = 1 << 23
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
FOLDED = CODES.copy()  # A-Z as a-z
FOLDED[ord("A"):ord("Z") + 1] = CODES[ord("a"):ord("z") + 1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first places of the lower-cased words of a byte string."""
    return chunk_hashes(data, SPACES, FOLDED)[:2]


def _roll(h: np.ndarray) -> np.ndarray:
    n = len(h) - SIZE + 1
    return mix(sum(h[j:n + j] * TURN[j] for j in range(SIZE)))


def _of_words(h: np.ndarray, rolled: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct shingles of a row of word hashes."""
    n = len(h)
    if n >= SIZE:
        return np.unique(_roll(h) if rolled is None else rolled)
    return mix((h * TURN[:n]).sum(keepdims=True) + np.uint64(n)) if n else h


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    waiting: list[bytes] = []
    held = 0

    def done() -> Iterator[np.ndarray]:
        h, starts = word_hashes(b"\n".join(waiting))
        ends = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in waiting]))
        rolled = _roll(h) if len(h) >= SIZE else h
        at = 0
        for end in ends.tolist():
            yield _of_words(h[at:end], rolled[at:end - SIZE + 1] if end - at >= SIZE else None)
            at = end

    for text in texts:
        data = text.encode()
        if len(data) > PART:  # word by word, in parts cut at white space
            parts, at = [], 0
            while at < len(data):
                stop = next((i for i in range(min(at + PART, len(data)), len(data)) if SPACES[data[i]]), len(data))
                parts.append(word_hashes(data[at:stop])[0])
                at = stop
            yield from done() if waiting else ()
            waiting, held = [], 0
            yield _of_words(np.concatenate(parts))
            continue
        waiting.append(data)
        held += len(data)
        if held > PART:
            yield from done()
            waiting, held = [], 0
    if waiting:
        yield from done()


def shingle_set(text: str) -> np.ndarray:
    return next(shingle_sets([text]))


def digest_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def node_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def levels(n: int, threshold: int) -> tuple[int, ...]:
    """The size bands in which a set of n shingles is joined."""
    own = (n.bit_length() - 1) // 2
    return (own, own + 1) if 100 * n >= threshold * 4 ** (own + 1) else (own,)


def reach(n: int, threshold: int) -> int:
    """The greatest symmetric difference of a set of n with a partner: that of the largest partner."""
    other = 100 * n // threshold
    return (100 - threshold) * (n + other) // (100 + threshold)


def asked(n: int) -> int:
    """How many common cells a set of n is indexed for."""
    return 1 + n // 10


def keys_of(shingles: np.ndarray, level: int, frequent: np.ndarray, threshold: int) -> tuple[np.ndarray, int]:
    """The join keys of a set in a size band, and how many of them any link shares at least."""
    n = len(shingles)
    cell = (shingles >> np.uint64(64 - 2 * level - 4)).astype(np.int64) if level < 30 else shingles.view(np.int64)
    starts = np.nonzero(np.r_[True, cell[1:] != cell[:-1]])[0]  # cells are runs of the sorted set
    value = np.bitwise_xor.reduceat(shingles, starts)
    light = np.ones(len(starts), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        light = np.logical_or.reduceat(frequent[at] != shingles, starts)
    key = mix(value + cell[starts].astype(np.uint64) * TURN[0] + np.uint64(level))
    far = reach(n, threshold)
    keys = key[np.lexsort((key, ~light))[:far + asked(n)]]
    # Sets with few filled cells may share none with a partner; these meet under one key.
    if len(starts) <= 2 * reach(100 * n // threshold, threshold):
        keys = np.r_[keys, mix(np.array([level], np.uint64))]
    least = min(asked(-(-threshold * n // 100)), len(starts) - far)
    return keys.view(np.int64), max(1, least) if len(starts) > 2 * reach(100 * n // threshold, threshold) else 1


def parity_bits(shingles: np.ndarray, level: int) -> bytes:
    """One bit a cell: the parity of its shingles."""
    width = 2 * 4 ** (level + 1)
    odd = np.bincount((shingles * TURN[1] >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column(column).to_pylist()


def _members(kind: str):
    """(id, text, hash of the text) to (id, h, n, node, digest), and now and then a row with frequent shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names = ["id", "h", "n", "node", "digest", "often", "times"]
        waiting: list[np.ndarray] = []
        held, id_type = 0, None

        def often() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(waiting), return_counts=True)
            most = times >= max(8, len(waiting) // 200)
            return pa.RecordBatch.from_arrays(
                [pa.array([None], id_type), *(pa.array([None], pa.int64()) for _ in range(3)), pa.array([None], pa.binary()),
                 pa.array([values[most].view(np.int64)], pa.list_(pa.int64())),
                 pa.array([times[most]], pa.list_(pa.int64()))], names)

        for part, texts in _texts(batches, 1):
            id_type = part.column(0).type
            sets = list(shingle_sets(texts))
            none = pa.nulls(len(sets), pa.list_(pa.int64()))
            digests = [digest_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([d and node_of(d) for d in digests], pa.int64()), pa.array(digests, pa.binary()), none, none], names)
            waiting += [s for s in sets if len(s)]
            held += sum(map(len, sets))
            if held > COUNTED:
                yield often()
                waiting, held = [], 0
        if waiting:
            yield often()

    return run, f"id {kind}, h bigint, n bigint, node bigint, digest binary, often array<bigint>, times array<bigint>"


class Steps:
    """Tables of a run in a folder of its own; those that are no longer read are removed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, scratch_path(spark, "jaccard")
        self.paths: list[tuple[DataFrame, str]] = []
        self.made = 0

    def path(self) -> str:
        self.made += 1
        return f"{self.folder}/{self.made}"

    def save(self, rows: DataFrame, *, instead_of: DataFrame | None = None) -> DataFrame:
        path = self.path()
        with small_batches(self.spark):
            rows.write.parquet(path)
        self.drop(instead_of)
        saved = self.spark.read.schema(rows.schema).parquet(path)
        self.paths.append((saved, path))
        return saved

    def drop(self, saved: DataFrame | None) -> None:
        for known, path in self.paths:
            if known is saved:
                drop_path(self.spark, path)
        self.paths = [x for x in self.paths if x[0] is not saved]


def _emit_keys(shipped, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        frequent, seen = shipped.value, set()
        for _, texts in _texts(batches, 0):
            keys, nodes, bands, needs, sizes = [], [], [], [], []
            for s in shingle_sets(texts):
                if not len(s) or (node := node_of(digest_of(s))) in seen:
                    continue
                seen.add(node)  # as many as documents in the task's split
                for level in levels(len(s), threshold):
                    k, least = keys_of(s, level, frequent, threshold)
                    keys.append(k)
                    nodes.append(np.full(len(k), node, np.int64))
                    bands.append(np.full(len(k), level, np.int32))
                    needs.append(np.full(len(k), least, np.int32))
                    sizes.append(np.full(len(k), len(s), np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (keys, nodes, bands, needs, sizes)],
                    ["key", "node", "level", "least", "n"])

    return run


def _emit_sets(bitmap, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        bits, seen = bitmap.value, set()
        for part, texts in _texts(batches, 0):
            places = part.column(1).to_numpy() & BITMAP - 1
            wanted = bits[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)
            rows = []
            for s in shingle_sets([t for t, w in zip(texts, wanted.tolist(), strict=True) if w]):
                if not len(s):
                    continue
                digest = digest_of(s)
                node = node_of(digest)
                if digest not in seen:
                    seen.add(digest)
                    rows.append((node, digest, len(s), [
                        {"level": x, "bits": parity_bits(s, x)} for x in levels(len(s), threshold)], s.tobytes()))
            if rows:
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("level", pa.int32()), ("bits", pa.binary())])), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["node", "digest", "n", "sketches", "shingles"])

    return run


def best_pairs(digests: list, n: np.ndarray, groups: list, sketches: np.ndarray, wrong: list, threshold: int, limit: int) -> list[tuple]:
    """Pairs between groups of a bucket: for each class at most the ``limit`` best ones, to classes of
    different groups behind it, among those that sizes and sketches allow and that have not been found wrong."""
    numbers = {g: k for k, g in enumerate(dict.fromkeys(groups))}
    labels = np.array([numbers[g] for g in groups])
    place = {d: k for k, d in enumerate(digests)}
    pairs = []
    for i in range(len(digests) - 1):
        rest = slice(i + 1, None)
        least, most = np.minimum(n[rest], n[i]), np.maximum(n[rest], n[i])
        fits = np.flatnonzero((most * threshold <= 100 * least) & (labels[rest] != labels[i])) + i + 1
        tested = [place[d] for d in wrong[i] or () if d in place]
        if tested:
            fits = np.setdiff1d(fits, tested)
        if not len(fits):
            continue
        off = np.bitwise_count(sketches[fits] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        good = off * (100 + threshold) <= (100 - threshold) * (n[fits] + n[i])
        # Those with the most room first, as these are the likeliest to hold. One partner in a group is
        # enough until that was found wrong.
        near = fits[good][np.argsort(off[good] / (n[fits[good]] + n[i]), kind="stable")]
        some = np.isin(labels[near], labels[tested])
        some[np.unique(labels[near], return_index=True)[1]] = True
        pairs += [(digests[i], digests[j]) for j in near[some][:limit].tolist()]
    return pairs


EDGES = "at bigint, x int, y int, u binary, v binary"


def _emit_edges(threshold: int, limit: int):
    """Rows (at, x, y, digest, n, group, bits, wrong), sorted by the first three, which name a
    bucket and its pair of blocks, to edges with these names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def done() -> list[tuple]:
            by = [list(c) for c in zip(*held, strict=True)]
            if len(held) < 2 or len(set(by[2])) < 2:
                return []
            sketches = np.frombuffer(b"".join(by[3]), np.uint8).reshape(len(held), -1)
            if sketches.shape[1] % 8 == 0:
                sketches = sketches.view(np.uint64)
            return [(*place, *e) for e in best_pairs(by[0], np.array(by[1]), by[2], sketches, by[4], threshold, limit)]

        def out(edges: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*edges, strict=True), types, strict=True)], ["at", "x", "y", "u", "v"])

        edges: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != place:
                    edges += done() if held else []
                    place, held = row[:3], []
                held.append(row[3:])
            if edges:
                yield out(edges)
                edges = []
        edges += done() if held else []
        if edges:
            yield out(edges)

    return run


def _verify(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, a, b = (c.to_pylist() for c in batch.columns)
            holds = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                holds.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(holds)], ["u", "v", "holds"])

    return run


def _enough(shared: DataFrame, threshold: int) -> DataFrame:
    """The rows (key, node, level, least, n) of sets that share enough of their keys with
    sets of a size near their own."""
    by_size = Window.partitionBy("key").orderBy("n", "node")
    near = (shared.withColumns({"before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)})
            .filter((F.col("before") * 100 >= F.col("n") * threshold) | (F.col("n") * 100 >= F.col("after") * threshold))
            .drop("before", "after"))
    some = (near.groupBy("node", "level", "least").agg(F.count(F.lit(1)).alias("has"))
            .filter(F.col("has") >= F.col("least")).select("node", "level"))
    return near.join(some, ["node", "level"], "left_semi")


def _verified(pairs: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """(u, v, holds) of pairs of digests, by their whole sets."""
    one, two = (known.select(F.col("digest").alias(d), F.col("shingles").alias(s)) for d, s in (("u", "a"), ("v", "b")))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "a", "b").mapInArrow(
        _verify(threshold), "u binary, v binary, holds boolean")


def _merged(steps: Steps, groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``groups`` (digest, component) after the edges (u, v) between digests."""
    ends = edges
    for end in ("u", "v"):
        ends = ends.join(groups.select(F.col("digest").alias(end), F.col("component").alias(f"c{end}")), end)
    stars = steps.path()
    joined = connected(ends.select(F.col("cu").alias("u"), F.col("cv").alias("v")), stars).select(
        F.col("node").alias("component"), F.col("component").alias("to"))
    after = steps.save(groups.join(joined, "component", "left").select(
        "digest", F.coalesce("to", "component").alias("component")), instead_of=groups)
    drop_path(steps.spark, stars)
    return after


def _join_to_firsts(steps: Steps, cells: DataFrame, groups: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """Groups after every class (key, level, digest, n) has met the smallest one of its keys."""
    by_key = Window.partitionBy("key", "level")
    first = F.min(F.struct(F.col("n").alias("m"), F.col("digest").alias("v"))).over(by_key)
    fits = (F.col("m") * 100 >= F.col("n") * threshold) & (F.col("digest") != F.col("v"))
    pairs = (cells.withColumn("first", first).select("n", F.col("digest"), "first.m", "first.v").filter(fits)
             .groupBy(F.col("digest").alias("u"), "v").agg(F.count(F.lit(1)).alias("times")))
    best = pairs.groupBy("u").agg(F.max_by("v", F.struct("times", "v")).alias("v"))
    right = steps.save(_verified(best, known, threshold).filter("holds").select("u", "v"))
    if not right.isEmpty():
        groups = _merged(steps, groups, right)
    steps.drop(right)
    return groups


def _partners(cells: DataFrame, groups: DataFrame, threshold: int) -> DataFrame:
    """The rows (key, level, digest, n) of keys that still have classes of two groups. ``others`` are the
    classes behind it of other groups and allowed sizes, null for keys of more than ``FEW`` classes."""
    by_key = Window.partitionBy("key", "level").orderBy("n", "digest")
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = F.collect_list(F.struct("digest", "n", "component")).over(by_key.rowsBetween(1, FEW - 1))
    fits = F.filter("others", lambda o: (o["component"] != F.col("component")) & (o["n"] * threshold <= F.col("n") * 100))
    return (cells.select("key", "level", "digest", "n").join(groups, "digest")
            .withColumns({"apart": F.min("component").over(whole) < F.max("component").over(whole), "size": F.count(F.lit(1)).over(whole)})
            .filter("apart").withColumn("others", behind)
            .select("key", "level", "digest", "n", F.when(F.col("size") <= FEW, F.transform(fits, lambda o: o["digest"])).alias("others"))
            .filter(F.col("others").isNull() | (F.size("others") > 0)))


def _join_counted(steps: Steps, cells: DataFrame, groups: DataFrame, needs: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """Groups after every pair of classes that shares keys of few classes only was joined, found wrong or
    already in one group. Such a pair is no link if it shares fewer keys than either class needs."""
    counted = (cells.select("level", F.col("digest").alias("u"), F.explode("others").alias("v"))
               .groupBy("u", "v", "level").agg(F.count(F.lit(1)).alias("times")))
    for end in ("u", "v"):
        counted = counted.join(needs.select(F.col("digest").alias(end), "level", F.col("least").alias(f"least_{end}")), [end, "level"])
    pairs = steps.save(counted.filter((F.col("times") >= F.col("least_u")) & (F.col("times") >= F.col("least_v")))
                       .groupBy("u", "v").agg(F.max("times").alias("times")))
    limit = 1
    while not pairs.isEmpty():
        left = pairs.filter("rank > 0") if limit > 1 else pairs
        for end in ("u", "v"):
            left = left.join(groups.select(F.col("digest").alias(end), F.col("component").alias(f"c{end}")), end)
        best = Window.partitionBy("u", "cv").orderBy(F.desc("times"), "v")
        pairs = steps.save(left.filter(F.col("cu") != F.col("cv")).withColumn("rank", F.row_number().over(best) - limit)
                           .select("u", "v", "times", "rank"), instead_of=pairs)
        right = steps.save(_verified(pairs.filter("rank <= 0").select("u", "v"), known, threshold).filter("holds").select("u", "v"))
        if not right.isEmpty():
            groups = _merged(steps, groups, right)
        steps.drop(right)
        limit *= 4
    steps.drop(pairs)
    return groups


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the least id of its group."""
    spark = docs.sparkSession
    steps = Steps(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    run, schema = _members(dict(rows.dtypes)["id"])
    members = steps.save(rows.mapInArrow(run, schema))

    # At most FREQUENT rows come to the driver: the order of cells, not their choice.
    often = members.filter(F.col("often").isNotNull()).select(F.explode(F.arrays_zip("often", "times")).alias("o"))
    often = most_frequent(often.groupBy("o.often").agg(F.sum("o.times").alias("times")), "times", FREQUENT)
    frequent = np.sort(np.array([r["often"] for r in often], np.int64).view(np.uint64))
    members = members.filter(F.col("n").isNotNull()).select("id", "h", "n", "node", "digest")

    by_key = Window.partitionBy("key")
    keyed = rows.select("text").mapInArrow(_emit_keys(spark.sparkContext.broadcast(frequent), threshold), "key bigint, node bigint, level int, least int, n bigint")
    shared = (keyed.withColumns({
        "low": F.min("node").over(by_key), "high": F.max("node").over(by_key)}).filter(F.col("low") < F.col("high")))
    # Written once, as the next step reads it twice.
    shared = steps.save(shared.select("key", "node", "level", "least", "n").distinct())
    for _ in range(2):  # each time sets go, others lose their partners
        shared = steps.save(_enough(shared, threshold), instead_of=shared)

    # Only texts that may be wanted are read into sets again; others that have their bit go in the join below.
    wanted = members.join(shared.select("node").distinct(), "node", "left_semi").select("h")
    words = wanted.select(
        F.expr(f"shiftright(h & {BITMAP - 1}, 6)").alias("w"),
        F.expr("shiftleft(1L, int(h & 63))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("bits")).collect()
    bitmap = np.zeros(BITMAP >> 6, np.int64)  # of fixed size
    for r in words:
        bitmap[r["w"]] = r["bits"]
    bits = spark.sparkContext.broadcast(bitmap.view(np.uint64))
    sets = rows.select("text", "h").mapInArrow(
        _emit_sets(bits, threshold), "node bigint, digest binary, n bigint, sketches array<struct<level:int,bits:binary>>, shingles binary")
    # Bucketed by digest, so that the joins below read it without a shuffle.
    table, n_parts = f"shingle_sets_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        with small_batches(spark):
            (sets.join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["digest"])
             .repartition(n_parts, "digest").write.bucketBy(n_parts, "digest").sortBy("digest")
             .option("path", f"{steps.folder}/sets").option("compression", "none").saveAsTable(table))
        groups = _groups(steps, shared, spark.table(table), threshold)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    drop_path(spark, f"{steps.folder}/sets")

    labelled = members.join(groups, "digest", "left").withColumn("group", F.coalesce("component", "digest"))
    least = labelled.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min("id").alias("least"))
    return (labelled.select("id", "n", "group").join(least, "group", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")))


def _groups(steps: Steps, shared: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """(digest, component) of all sets with keys that others share."""
    cells = steps.save(shared.join(known.select("digest", "node"), "node").select("key", "level", "digest", "n", "least"), instead_of=shared)
    needs = steps.save(cells.select("digest", "level", "least").distinct())
    groups = steps.save(needs.select("digest").distinct().withColumn("component", F.col("digest")))
    groups = _join_to_firsts(steps, cells, groups, known, threshold)
    cells = steps.save(_partners(cells, groups, threshold), instead_of=cells)
    groups = _join_counted(steps, cells, groups, needs, known, threshold)
    steps.drop(needs)

    # Pairs that share a key of many classes.
    many = cells.filter(F.col("others").isNull())
    signed = many.groupBy("key", "level").agg(F.bit_xor(F.xxhash64("digest")).alias("bucket"), F.count(F.lit(1)).alias("size"))
    met = many.join(signed, ["key", "level"]).select("bucket", "size", "level", "digest", "n").distinct()
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = met.withColumn("parts", parts).withColumn("block", block).withColumn("other", other)
    met = steps.save(met.select(F.xxhash64("bucket", "level").alias("at"), F.least("block", "other").alias("x"),
                                F.greatest("block", "other").alias("y"), "digest", "n", "level"), instead_of=cells)
    place, limit = ["at", "x", "y"], 1
    tried = f"{steps.folder}/wrong"
    wrong = None
    while True:
        now = met.join(groups, "digest").withColumnRenamed("component", "group")
        now = now.withColumn("wrong", F.lit(None).cast("array<binary>")) if wrong is None else (
            now.join(wrong.groupBy(F.col("a").alias("digest")).agg(F.collect_set("b").alias("wrong")), "digest", "left"))
        bits = F.get(F.filter("sketches", lambda k: k["level"] == F.col("level")), F.lit(0))["bits"]
        now = now.join(known.select("digest", "sketches"), "digest").withColumn("bits", bits)
        dealt = (now.select(*place, "digest", "n", "group", "bits", "wrong")
                 .repartition(*place).sortWithinPartitions(*place, "digest"))
        found = steps.save(dealt.mapInArrow(_emit_edges(threshold, limit), EDGES))
        if found.isEmpty():
            steps.drop(found)
            break
        # Groups only grow: a bucket without an edge now will have none later.
        met = steps.save(met.join(found.select(*place).distinct(), place, "left_semi"), instead_of=met)
        tested = steps.save(_verified(found.select("u", "v").distinct(), known, threshold), instead_of=found)
        right, no = tested.filter("holds").select("u", "v"), tested.filter("not holds")
        no.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
            no.select(F.col("v").alias("a"), F.col("u").alias("b"))).write.mode("append").parquet(tried)
        wrong = steps.spark.read.schema("a binary, b binary").parquet(tried)
        if not right.isEmpty():
            groups = _merged(steps, groups, right)
        steps.drop(tested)
        limit *= 4
    steps.drop(met)
    drop_path(steps.spark, tried)
    return groups
