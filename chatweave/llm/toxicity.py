"""Toxicity scores from subword embeddings.

A text is the bag of the character n-grams (``SIZES`` characters) of its words, A-Z in lower
case, a word's ends counted as characters; a word is a run of letters, digits and characters beyond ASCII. Each n-gram is
hashed to one of ``2**BITS`` rows of an embedding table. The rows of a text, and ``PADS`` rows of zeros
(so that a handful of n-grams alone decides little), are averaged and go through a linear softmax over the two labels; the table and the softmax are trained jointly,
with numpy. A misspelt or inflected word that no training text holds still shares most of its
n-grams, hence its vectors, with words that were seen.

Training uses at most about ``max_rows`` labelled texts of each label (whole texts, those of the
lowest digests of their ids; rows of a label are weighted up to the label's share, so that scores
keep the proportions of the labels). Their n-grams are counted on the workers; the driver gets
the counts, at most ``2**BITS`` for each of these texts, and holds nothing else of the table.

Scoring. Averaging and the linear layer commute, so the difference of the two logits is the
average of one number per table row. This vector of fixed size is broadcast; each text is scored on
the workers from all its n-grams, whatever its length, in parts of bounded size. Nothing is shuffled.

Defined cases: null text is empty; a text without n-grams gets the score of the bias alone; label
rows with a label other than 0 or 1, or without text, teach nothing; several label rows of
one id teach once each; without labelled texts of both kinds the score is the share of label 1 (with one added to
each count) for all texts; other columns are ignored, whatever their names; repeated rows are scored each; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatweave.operators.joins import bounded_broadcast

BITS = 18
DIM = 8
SIZES = (3, 4, 5)
PART = 1_000_000
SLICE = 256
MAX_ROWS = 1200
FACTOR, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
STEPS = 100
RATE = 0.1
DECAY = 3e-6
LEAST_TEXTS = 3
PADS = 200


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of texts in a row, 0 for what is between words, and where each text starts."""
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32).astype(np.int32)
    codes[(codes >= 65) & (codes <= 90)] += 32
    apart = (codes < 48) | (codes > 57) & (codes < 97) | (codes > 122) & (codes < 128)
    codes[apart] = 0
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return codes, starts


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Table rows of the n-grams of all texts, with the number of the text each is from, in parts."""
    codes, starts = characters(texts)
    most = max(SIZES)
    for at in range(0, len(codes), PART):
        part = codes[at:at + PART + most - 1]
        gaps = np.cumsum(part == 0)
        wide = part.astype(np.uint64)
        value = wide.copy()
        for size in range(2, most + 1):
            n = min(PART, len(part) - size + 1)
            if n <= 0:
                break
            value = value[:len(part) - size + 1] * FACTOR + wide[size - 1:]
            if size not in SIZES:
                continue
            # All characters but the first and the last are of one word.
            whole = np.flatnonzero(gaps[size - 2:size - 2 + n] == gaps[:n])
            rows = (value[whole] + np.uint64(size)) * SPREAD >> np.uint64(64 - BITS)
            yield rows.astype(np.int64), np.searchsorted(starts, whole + (at + 1), "right") - 1


@dataclass
class Examples:
    """Training texts as counts of table rows: those of text i are from ``starts[i]`` on."""

    rows: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    """Embedding rows of the n-grams met in training, and the softmax over their average."""

    rows: np.ndarray
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """Per table row what it adds to the difference of the logits, before averaging."""
        flat = np.zeros(1 << BITS, np.float32)
        flat[self.rows] = self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])
        return flat

    def base(self) -> float:
        return float(self.bias[1] - self.bias[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(given: Examples, steps: int = STEPS, rate: float = RATE, decay: float = DECAY,
          least_texts: int = LEAST_TEXTS, seed: int = 1) -> Model:
    """Fit embeddings and softmax by full gradients; the same for the same examples.

    N-grams of fewer than ``least_texts`` texts have no vector, and vectors start at zero, so that
    what was not learned adds nothing. Steps are those of Adam.
    """
    y, weight = given.labels.astype(np.float64), given.weights / given.weights.sum()
    often = np.bincount(given.rows, minlength=1 << BITS) >= least_texts
    rows = np.flatnonzero(often)
    kept = often[given.rows]
    number = (np.cumsum(often, dtype=np.int32) - 1)[given.rows[kept]]
    sizes = np.diff(given.starts)
    whole = np.add.reduceat(given.counts, given.starts[:-1]) + PADS
    doc = np.repeat(np.arange(len(y), dtype=np.int32), sizes)[kept]
    share = (given.counts[kept] / whole[doc]).astype(np.float32)
    order = np.argsort(number, kind="stable")
    first = np.flatnonzero(np.diff(number[order], prepend=-1))
    by_row_doc, by_row_share = doc[order], share[order]
    del order, kept
    rng = np.random.default_rng(seed)
    prior = float((weight * y).sum())
    table = [np.zeros((len(rows), DIM)), rng.uniform(-1, 1, (DIM, 2)), np.array([np.log1p(-prior), np.log(prior)])]
    sums, squares = ([np.zeros_like(x) for x in table] for _ in range(2))
    for step in range(1, steps + 1):
        embeddings, softmax, bias = table
        margin = embeddings @ (softmax[:, 1] - softmax[:, 0])
        z = np.bincount(doc, margin[number] * share, len(y)) + bias[1] - bias[0]
        off = (_sigmoid(z) - y) * weight  # of the loss, by the second logit; the first has the opposite
        pull = np.add.reduceat(by_row_share * off[by_row_doc], first) if len(first) else np.zeros(0)
        pull = np.stack([-pull, pull], axis=1)
        slopes = [pull @ softmax.T + decay * embeddings, embeddings.T @ pull + decay * softmax, np.array([-off.sum(), off.sum()])]
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))  # falls to 0 in the second half
        for i, slope in enumerate(slopes):
            sums[i] = 0.9 * sums[i] + 0.1 * slope
            squares[i] = 0.999 * squares[i] + 0.001 * slope * slope
            table[i] = table[i] - now * sums[i] / (1 - 0.9**step) / (np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-12)
    return Model(rows, *table)


def text_rows(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text the different table rows of its n-grams, ascending, and their counts."""
    for text in texts:
        rows, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for more, _ in grams([text]):
            merged, inverse = np.unique(np.concatenate([rows, more]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, np.ones(len(more), np.int64)])).astype(np.int64)
            rows = merged
        yield rows, counts


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            found = list(text_rows(part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([r.astype(np.int32).tobytes() for r, _ in found], pa.binary()),
                 pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())], ["label", "rows", "counts"])


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of about ``max_rows`` labelled texts of each label at most, and the rows of each label."""
    told = labels.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull()).select("id", "label")
    sizes = {r["label"]: r["n"] for r in told.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ids of the lowest digests, as many as fit; the whole label where it is small.
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, max_rows / n))).otherwise(share)
    digest = F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = told.filter(digest < share)
    # Some max_rows rows a label: counted before it is sent to all tasks, so that no text is shuffled.
    return docs.join(bounded_broadcast(chosen), "id").select("label", "text"), sizes


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | float:
    """A model from (id, text) and (id, label), or the share of label 1 where only one label is there."""
    sample, sizes = labelled_sample(docs.filter(F.col("text").isNotNull()), labels, max_rows)
    found = sample.mapInArrow(_count_rows, "label int, rows binary, counts binary").toArrow()
    found = found.filter(pa.compute.greater(pa.compute.binary_length(found.column("rows")), 0)).sort_by(
        [("label", "ascending"), ("rows", "ascending"), ("counts", "ascending")])  # the same sums whatever the order of tasks
    label = np.array(found.column("label").to_pylist(), np.int64)
    if len(set(label.tolist())) < 2:
        return (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    rows = [np.frombuffer(x, np.int32) for x in found.column("rows").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in found.column("counts").to_pylist()])
    weight = np.array([sizes[x] / (label == x).sum() for x in (0, 1)])[label]
    starts = np.r_[0, np.cumsum([len(r) for r in rows])]
    return train(Examples(np.concatenate(rows), counts, starts, label, weight))


def _score(shared, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                total, n = np.zeros(len(texts)), np.zeros(len(texts))
                for rows, doc in grams(texts):
                    total += np.bincount(doc, margins[rows], len(texts))
                    n += np.bincount(doc, minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(_sigmoid(total / (n + PADS) + base))], ["id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(``id_col``, score) for all rows of ``docs``, learned from label rows for which ``learn`` holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    used = labels if learn is None else labels.filter(learn)
    model = fit(rows, used.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")), max_rows)
    if isinstance(model, Model):
        margins, base = model.margins(), model.base()
    else:
        margins, base = np.zeros(1 << BITS, np.float32), float(np.log(model / (1 - model)))
    scored = rows.select("id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _score(spark.sparkContext.broadcast(margins), base), f"id {dict(rows.dtypes)['id']}, score double")
    return scored.select(F.col("id").alias(id_col), "score")
