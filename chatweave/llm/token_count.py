"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at special strings (one token each) and into pieces by the pattern of
byte-level vocabularies. The symbols of a piece, first its bytes, form a linked list; a heap
holds the ranks of adjacent pairs that may merge. The pair of the lowest rank (the
leftmost of equals) is popped and merged until the heap is empty. A piece has as many tokens as bytes
minus merges. No token identifier is made.

Pieces repeat, so each Python worker remembers the counts of up to ``CACHE`` pieces of up to ``LONGEST`` characters and starts
over when that is full.

Defined cases: null text is empty, 0 bytes and 0 tokens; rows and ids may repeat, each row
is counted; other columns are ignored, whatever their names; texts of any length are counted whole.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 700_000
LONGEST = 200
SLICE = 256
# Below this code point the pattern means the same in every Unicode version.
SETTLED = re.compile("[^\x00-ͯ]")
LONG = 1_000_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if visible Latin-1, else one from 256 up."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def count_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding makes on a row of symbols."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
            if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = left + right, ""
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
    return merges


class PieceCounts(dict):
    """Tokens of a piece, worked out when first asked for."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        super().__init__()
        self.ranks, self.symbols = ranks, byte_symbols()

    def __missing__(self, piece: str) -> int:
        data = piece.encode()
        n = len(data) - count_merges([self.symbols[b] for b in data], self.ranks)
        if len(piece) <= LONGEST:  # longer ones are rare, and would fill the memory
            if len(self) >= CACHE:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Counts the tokens of texts under one byte-level vocabulary file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.pieces = PieceCounts({p: i for i, p in enumerate(pairs)})
        self.find = regex.compile(PATTERN)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # Only for characters whose class depends on the Unicode version of the file's library.
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def _plain(self, text: str) -> int:
        if not text.isascii() and SETTLED.search(text):
            back = {s: b for b, s in enumerate(self.pieces.symbols)}
            return sum(self.pieces[bytes(back[c] for c in p).decode("utf-8", "surrogateescape")]
                       for p, _ in self.cut(text))
        if len(text) > LONG:
            return sum(self.pieces[m.group()] for m in self.find.finditer(text))
        return sum(map(self.pieces.__getitem__, self.find.findall(text)))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        return len(self.special.findall(text)) + sum(map(self._plain, filter(None, self.special.split(text))))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker process, kept between tasks."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8) and ``n_tokens``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([count(t) for t in texts], pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", id_col)
