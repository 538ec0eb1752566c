"""Language-model scoring with a subword lattice.

The vocabulary of an existing subword tokenizer gives the pieces of the lattice and their
weights. Its scores are ranks, ``-r``; a piece gets probability in proportion to
``1 / (r + SHIFT)``, the usual fall of frequency with rank, and bytes the weight of the last
rank. A word is read as a word mark and its characters; a forward recursion in
logarithms sums over all its segmentations, which gives the probability of the word's spelling.

These weights count as ``PRIOR`` pieces; to them comes how often the segmentations of all
distinct training words use each piece, from forward and backward sums.

The corpus gives the other arc of a word: its whole form, weighted by its count in the
training documents. With count c, N training tokens and V distinct ones,

    P(word) = (c + V * spelling(word)) / (N + V)

so words that were never seen keep the probability of their spelling, and all words
together have probability one. A text is its words and one end, a token like the others; its score
is the sum of log10 P. The add-one score of the same counts is given beside it.

Training documents are those whose ``crc32(id as text) mod folds`` is not ``fold``.

Defined cases: null text is empty: one token, the end. Null ids hash as an empty text. Repeated
rows and ids are documents of their own. No training document at all leaves N = V = 0 and
known counts of zero; scores are then of spelling alone, and the end counts as one half. Extra columns are ignored. Very long words cost time in proportion to their length.

How it runs: one pass counts words map-side and adds up. The ``head`` most frequent words (a fixed
number) are shipped to the workers. The second pass scores each document's head words in place
and leaves its other words with their counts; these meet the word table in one join, are scored once
per distinct word, and are summed per document. No frequent word is shuffled per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.llm.frequent import most_frequent
from chatweave.session import scratch_path

END = b""
HEAD = 200_000
SHIFT = 10.0
FLUSH = 400_000
SLICE = 512
MARK = "▁"
GROUP = 2048
STEP = 0x9E3779B97F4A7C15
PRIOR = 1000.0
ROUNDS = 1
LN10 = log(10)


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space with A-Z in lower case, and the end."""
    return [*text.encode().lower().split(), END]


class Lattice:
    """The vocabulary's pieces with their first weights, and sums over segmentations.

    Words of one length are worked on together: for every start and end the rolling hash of
    the characters between finds the piece, and sums go over all words at once.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = {}
        for i in range(n):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i)):
                pieces.setdefault(model.id_to_piece(i), 1 / (min(-model.get_score(i), n) + SHIFT))
        # Piece k has the weight k; byte b the weight len(pieces) + b.
        self.start = np.array([*pieces.values(), *[1 / (n + SHIFT)] * 256])
        self.start /= self.start.sum()
        self.single = {p: k for k, p in enumerate(pieces) if len(p) == 1}
        self.n_pieces, self.longest = len(pieces), max(map(len, pieces))
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * STEP + ord(c)) % 2**64
        return h

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[str]]]:
        """Places of the words of one length, and these as marked text; long words alone."""
        by: dict[int, list[int]] = {}
        texts = [MARK + w.decode("utf-8", "replace") for w in words]
        for i, t in enumerate(texts):
            by.setdefault(len(t), []).append(i)
        for at in by.values():
            for k in range(0, len(at), GROUP):
                part = at[k:k + GROUP]
                yield np.array(part), [texts[i] for i in part]

    def _arcs(self, texts: list[str], weights: np.ndarray) -> tuple[dict, list]:
        """(start, end) to (rows, pieces) of the arcs there, and byte arcs of characters
        that are no piece: (place, rows, bytes, their weight)."""
        length = len(texts[0])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).reshape(len(texts), length)
        codes = codes.astype(np.uint64)
        arcs, loose = {}, []
        for start in range(length):
            h = np.zeros(len(texts), np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                h = h * np.uint64(STEP) + codes[:, end - 1]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                rows = np.nonzero(self.hashes[at] == h)[0]
                if len(rows):
                    arcs[start, end] = (rows, self.order[at[rows]])
            for i in np.nonzero(~np.isin(np.arange(len(texts)), arcs.get((start, start + 1), ((), ()))[0]))[0]:
                ids = [self.n_pieces + x for x in texts[i][start].encode("utf-8", "replace")]
                loose.append((start, i, ids, weights[ids].sum()))
        return arcs, loose

    def _ahead(self, n: int, length: int, arcs: dict, loose: list, weights: np.ndarray) -> np.ndarray:
        """The forward recursion: ln of the sum over segmentations of each prefix."""
        ahead = np.full((length + 1, n), -np.inf)
        ahead[0] = 0.0
        by_place: dict[int, list] = {}
        for place, i, _, w in loose:
            by_place.setdefault(place + 1, []).append((i, w))
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):
                if (start, end) in arcs:
                    rows, pieces = arcs[start, end]
                    ahead[end, rows] = np.logaddexp(ahead[end, rows], ahead[start, rows] + weights[pieces])
            for i, w in by_place.get(end, ()):
                ahead[end, i] = np.logaddexp(ahead[end, i], ahead[end - 1, i] + w)
        return ahead

    def spellings(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """ln of the probability of each spelling; ``weights`` are ln of piece probabilities."""
        out = np.empty(len(words))
        for at, texts in self._groups(words):
            arcs, loose = self._arcs(texts, weights)
            out[at] = self._ahead(len(texts), len(texts[0]), arcs, loose, weights)[-1]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """How often each piece is used, summed over the words, by forward and backward sums."""
        uses = np.zeros(len(weights))
        for _, texts in self._groups(words):
            n, length = len(texts), len(texts[0])
            arcs, loose = self._arcs(texts, weights)
            ahead = self._ahead(n, length, arcs, loose, weights)
            back_arcs = {(length - e, length - s): v for (s, e), v in arcs.items()}
            back_loose = [(length - 1 - p, i, ids, w) for p, i, ids, w in loose]
            behind = self._ahead(n, length, back_arcs, back_loose, weights)
            whole = ahead[-1]
            for (s, e), (rows, pieces) in arcs.items():
                share = np.exp(ahead[s, rows] + weights[pieces] + behind[length - e, rows] - whole[rows])
                uses += np.bincount(pieces, share, len(uses))
            for p, i, ids, w in loose:
                np.add.at(uses, ids, np.exp(ahead[p, i] + w + behind[length - 1 - p, i] - whole[i]))
        return uses


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


class Scores:
    """log10 probabilities of words from their counts."""

    def __init__(self, path: str, n: int, v: int, weights: np.ndarray):
        self.lattice, self.n, self.v, self.weights = lattice(path), n, v, weights

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))

    def full(self, words: list[bytes], c: np.ndarray) -> np.ndarray:
        rare = self.lattice.spellings(words, self.weights)
        if self.v:
            with np.errstate(divide="ignore"):
                rare = np.logaddexp(rare + log(self.v / (self.n + self.v)), np.log(c / (self.n + self.v)))
        if END in words:
            at = words.index(END)
            rare[at] = log((c[at] or 0.5) / (self.n + self.v or 1))
        return rare / LN10


def count_words(docs: DataFrame) -> DataFrame:
    """docs (text) to (word, c)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(at, SLICE).to_pylist():
                    seen.update(tokens(text))
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return docs.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def fit_pieces(table: DataFrame, path: str, prior: float = PRIOR, rounds: int = ROUNDS) -> np.ndarray:
    """ln of piece probabilities: the vocabulary's weights, worth ``prior`` pieces, and how often
    the segmentations of all distinct training words use each piece under them."""
    grid = lattice(path)
    p = grid.start
    for _ in range(rounds):
        weights = np.log(p)

        def use(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            uses = np.zeros(len(weights))
            for batch in batches:
                uses += lattice(path).expected([w for w in batch.column(0).to_pylist() if w != END], weights)
            at = np.nonzero(uses)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(uses[at])], ["piece", "uses"])

        # At most one row per piece of the vocabulary.
        rows = table.select("word").mapInArrow(use, "piece bigint, uses double").groupBy("piece").agg(
            F.sum("uses").alias("uses")).collect()
        total = sum(r["uses"] for r in rows)
        p = grid.start * prior / (total + prior)
        for r in rows:
            p[r["piece"]] += r["uses"] / (total + prior)
    return np.log(p)


def score_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
                    folds: int = 7, fold: int = 2, head: int = HEAD) -> DataFrame:
    """Per row: the id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = scratch_path(spark, "word-counts")
    count_words(rows.filter(~F.col("held_out")).select("text")).write.parquet(counted)
    table = spark.read.parquet(counted)
    total = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"], total["v"]
    weights = fit_pieces(table, path)
    top = {bytes(r["word"]): r["c"] for r in most_frequent(table, "c", head)}
    shipped = spark.sparkContext.broadcast(top)

    kind = dict(rows.dtypes)["id"]
    schema = (f"key bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, "
              "score double, words array<binary>, counts array<int>")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, words = Scores(path, n, v, weights), list(shipped.value)
        c = np.array(list(shipped.value.values()), float)
        known = dict(zip(words, zip(score.base(c).tolist(), score.full(words, c).tolist(), strict=True), strict=True))
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = []
                for text in part.column(2).to_pylist():
                    words, base, full, seen = Counter(tokens(text)), 0.0, 0.0, 0
                    rest, times = [], []
                    for w, k in words.items():
                        p = known.get(w)
                        if p is None:
                            rest.append(w)
                            times.append(k)
                            continue
                        base += k * p[0]
                        full += k * p[1]
                        seen += k
                    made.append((key, sum(words.values()), seen, base, full, rest, times))
                    key += 1
                cols = list(zip(*made, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
                arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [arrays[0], part.column(0), part.column(1), *arrays[1:]],
                    ["key", "id", "held_out", "n_tokens", "n_known", "base", "score", "words", "counts"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scores(path, n, v, weights)
        for batch in batches:
            key, word, times, c = batch.columns
            once = word.dictionary_encode()
            words, at = once.dictionary.to_pylist(), once.indices.to_numpy(zero_copy_only=False)
            counts = np.zeros(len(words))
            counts[at] = c.fill_null(0).to_numpy(zero_copy_only=False)
            k = times.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(np.where(counts[at] > 0, k, 0), pa.int64()), pa.array(k * score.base(counts)[at]),
                 pa.array(k * score.full(words, counts)[at])], ["key", "known", "base", "score"])

    half = scratch_path(spark, "half-scored")
    rows.select("id", "held_out", "text").mapInArrow(first, schema).write.parquet(half)
    done = spark.read.schema(schema).parquet(half)
    tail = done.select("key", F.explode(F.arrays_zip("words", "counts")).alias("w")).select(
        "key", F.col("w.words").alias("word"), F.col("w.counts").alias("times"))
    met = (tail.hint("merge").join(table, "word", "left").select("key", "word", "times", "c")
           .mapInArrow(rest, "key bigint, known bigint, base double, score double"))
    sums = met.groupBy("key").agg(*[F.sum(x).alias(f"tail_{x}") for x in ("known", "base", "score")])
    zero = F.lit(0.0)
    return done.drop("words", "counts").join(sums, "key", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", zero)).alias("score"))
