"""Best-fit packing of token sequences.

Documents become pieces: cuts of ``capacity`` tokens, and a rest. Full pieces are sequences of
their own. Rests go to the open sequence with the least free space that holds them. Open
sequences are found through one integer whose bit ``f`` is set while a sequence with
``f`` free places is open, so the best fit is the lowest set bit from the piece's length
up. At most ``open_bins`` are open; when another is needed, the fullest closes.

How it runs: each scan task tokenises and packs its documents in one pass and holds only the pieces
of its open sequences (``open_bins`` times ``capacity`` ids at most). The pieces are
written to the shared folder. Those of sequences still open at a task's end, a small share
of a large split, are dealt out anew, sorted by length and packed once more, in tasks of about
``regroup`` sequences. All other pieces are final and never shuffled.

Token ids come from the vocabulary's library by white-space-separated chunk; such a
vocabulary drops white space, and chunks repeat, so each worker remembers the ids of up to
``CACHE`` chunks and ``HELD`` ids, until it gets a task of another operator.

Defined cases: null text is empty and gives the end token alone; repeated ids and rows are
packed as they come; null ids pass through; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.llm.hashing import chunk_hashes
from chatweave.llm.kept import keep
from chatweave.llm.token_count import byte_symbols
from chatweave.session import scratch_path, small_batches

# Chunks remembered, 20 bytes each or so, before a worker starts over.
CACHE = 4_000_000
# Ids remembered, 4 bytes each: a few chunks may be very long.
HELD = 32_000_000
RECENT = 150_000
SLICE = 128
FLUSH = 1_000
LONG = 200
CUTS = np.isin(np.arange(256), [32, 10])


class BestFit:
    """Bounded-space online best fit. ``place`` returns (sequence, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.mask, self.n_open, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return bin_

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self.closed.append(self._take((self.mask & -self.mask).bit_length() - 1))
            free, bin_ = self.capacity, self.made
            self.made += 1
        rest = free - size
        if rest:
            self.by_free.setdefault(rest, []).append(bin_)
            self.mask |= 1 << rest
            self.n_open += 1
        else:
            self.closed.append(bin_)
        return bin_, self.capacity - free


class ChunkIds:
    """Ids of the chunks between blanks and line feeds, a batch of texts at a time.

    Chunks are hashed all at once (long ones by themselves, with a strong hash); different
    hashes of a batch are looked up in a sorted array, and only new chunks become strings. Most
    of these are a word of Latin-1 letters and punctuation, which the vocabulary's pattern
    parts in the same way; its merges are asked for directly. All other chunks take its whole way.
    """

    # Letters whose case and composition no library disagrees on; no apostrophe, no "<".
    SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        self.encode, self.merge = model.encode_batch_fast, model.model.tokenize
        self.symbols = dict(enumerate(byte_symbols()))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted, with the entry of each
        self.entries = np.zeros(0, np.int32)
        self.recent: dict[int, int] = {}
        self.n = 0
        self.store, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.size = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, np.int32)

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Entries of new chunks, whose ids follow each other."""
        while self.used + len(ids) > len(self.store):
            self.store = np.r_[self.store, np.zeros_like(self.store)]
        while self.n + len(sizes) > len(self.size):
            self.start, self.size = np.r_[self.start, np.zeros_like(self.start)], np.r_[self.size, np.zeros_like(self.size)]
        self.store[self.used:self.used + len(ids)] = ids
        made = np.arange(self.n, self.n + len(sizes))
        self.start[made], self.size[made] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.n = self.used + len(ids), self.n + len(sizes)
        return made

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        found = [m.groups() if (m := self.SIMPLE.fullmatch(c)) else (None, c) for c in chunks]
        ids: dict[str, list[int]] = {"": []}
        for word in {x for w, t in found if w is not None for x in (w, t) if x}:
            # Bytes as the vocabulary's symbols; letters of these chunks have one lower case.
            symbols = word.lower().encode().decode("latin-1").translate(self.symbols)
            ids[word] = [t.id for t in self.merge(symbols)]
        rest = [t for w, t in found if w is None]
        alone = iter(self.encode(rest, add_special_tokens=False))
        all_ids = [ids[w] + ids[t] if w is not None else next(alone).ids for w, t in found]
        sizes = np.fromiter(map(len, all_ids), np.int64, len(all_ids))
        return np.fromiter(chain.from_iterable(all_ids), np.uint32, int(sizes.sum())), sizes

    def _entries_of(self, hashes: np.ndarray, text_at) -> np.ndarray:
        """Entries of different hashes; text_at(i) is the chunk of the i-th."""
        out = np.full(len(hashes), -1)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            out[hit] = self.entries[at[hit]]
        left = np.flatnonzero(out < 0)
        get = self.recent.get
        out[left] = [get(h, -1) for h in hashes[left].tolist()]
        new = np.flatnonzero(out < 0)
        if len(new):
            ids, sizes = self._encode([text_at(i) for i in new.tolist()])
            out[new] = made = self._append(ids, sizes)
            self.recent.update(zip(hashes[new].tolist(), made.tolist()))
        if len(self.recent) > RECENT:
            keys = np.r_[self.keys, np.fromiter(self.recent.keys(), np.uint64, len(self.recent))]
            entries = np.r_[self.entries, np.fromiter(self.recent.values(), np.int32, len(self.recent))]
            order = np.argsort(keys)
            self.keys, self.entries, self.recent = keys[order], entries[order], {}
        return out

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        if self.n > CACHE or self.used > HELD:
            self._forget()
        parts = [t.encode() for t in texts]
        data = b"\n".join(parts)
        hashes, starts, sizes = chunk_hashes(data, CUTS)
        for i in np.flatnonzero(sizes > LONG).tolist():
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + sizes[i]])
        different, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        entries = self._entries_of(different, lambda i: data[starts[first[i]]:starts[first[i]] + sizes[first[i]]].decode())
        used = entries[back]
        n = self.size[used]
        ends = np.cumsum(n)
        ids = self.store[np.repeat(self.start[used] - ends + n, n) + np.arange(int(n.sum()))]
        cuts = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts]))
        at = 0
        for cut in cuts.tolist():
            end = int(ends[cut - 1]) if cut else 0
            yield ids[at:end]
            at = end


def chunk_ids(path: str) -> ChunkIds:
    return keep(("chunk ids", path), lambda: ChunkIds(path))


NAMES = ["id", "piece", "start", "length", "ids", "sequence_id", "offset", "final"]


def _schema(kind: str) -> str:
    return (f"id {kind}, piece int, start bigint, length bigint, ids binary, sequence_id bigint, "
            "`offset` bigint, final boolean")


class Writer:
    """Packs pieces and gives rows out when their sequence closes."""

    def __init__(self, capacity: int, open_bins: int, base: int, id_type: pa.DataType):
        self.fit, self.base, self.id_type = BestFit(capacity, open_bins), base, id_type
        self.waiting: dict[int, list[tuple]] = {}
        self.ready: list[tuple] = []

    def add(self, row: tuple) -> None:
        """row: id, piece, start, length, ids"""
        bin_, offset = self.fit.place(row[3])
        self.waiting.setdefault(bin_, []).append((*row, self.base + bin_, offset))
        for done in self.fit.closed:
            self.ready += [(*r, True) for r in self.waiting.pop(done)]
        self.fit.closed.clear()

    def end(self, final: bool) -> None:
        for rows in self.waiting.values():
            self.ready += [(*r, final) for r in rows]
        self.waiting.clear()

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.ready) >= least:
            types = [self.id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
            for at in range(0, len(self.ready), FLUSH):
                cols = zip(*self.ready[at:at + FLUSH], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], NAMES)
            self.ready = []


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
                   capacity: int = 4096, end_id: int = 1, open_bins: int = 512,
                   regroup: int = 1024) -> DataFrame:
    """Per piece: the id, piece, start, length, ids (binary, little-endian 32 bit),
    sequence_id and offset."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = chunk_ids(path), None
        for batch in batches:
            out = out or Writer(capacity, open_bins, TaskContext.get().partitionId() << 32, batch.column(0).type)
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for id_, ids in zip(part.column(0).to_pylist(), known.texts(part.column(1).to_pylist()), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        cut = ids[4 * start:4 * (start + capacity)]
                        out.add((id_, piece, start, len(cut) // 4, cut))
                yield from out.flush(FLUSH)
        if out:
            out.end(False)
            yield from out.flush()

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            out = out or Writer(capacity, open_bins, (1 << 62) + (TaskContext.get().partitionId() << 32),
                                batch.column(0).type)
            for row in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                out.add(row)
            yield from out.flush(FLUSH)
        if out:
            out.end(True)
            yield from out.flush()

    first = scratch_path(spark, "packed")
    with small_batches(spark):
        rows.mapInArrow(tokenise, _schema(kind)).write.partitionBy("final").parquet(first)
    made = spark.read.schema(_schema(kind)).parquet(first)
    left = made.filter(~F.col("final"))
    tokens = left.agg(F.sum("length")).first()[0] or 0
    tasks = 1 + tokens // (capacity * regroup)
    again = (left.repartition(int(tasks)).sortWithinPartitions(F.desc("length"), F.col("id"), "piece")
             .mapInArrow(repack, _schema(kind)))
    return (made.filter("final").unionByName(again).drop("final")
            .withColumnRenamed("id", id_col))
