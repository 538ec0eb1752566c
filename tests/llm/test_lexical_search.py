"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chatweave.llm import lexical_search
from chatweave.llm.lexical_search import Block, best_positions, rank_documents, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for d, c in held:
            n, score = sum(c.values()), 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * total // length)))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        for rank, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1):
            out[item, rank, d, -s] += 1
    return out


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def corpus(rng, n):
    vocab = [f"w{i}" for i in range(60)] + ["Ärger", "日本", "x-y", "İ", "ſ"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    return docs, vocab


@pytest.mark.parametrize("postings", [lexical_search.POSTINGS, 50])
def test_same_as_brute_force(spark, postings):
    rng = random.Random(7)
    docs, vocab = corpus(rng, 300)
    docs += [(5, docs[9][1]), (None, docs[9][1]), (None, "w3 w3"), (901, None), (902, ""), (903, " .-\x00\x7f")]
    docs += [(1000 - i, "W1 ärger ÄRGER w59") for i in range(80)]  # ties, many more than k
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 20])))) for i in range(12)]
    items += [(3, "w59 W59 w1"), (None, "w2"), (50, None), (51, "!"), (52, "unheard")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS n", "2 AS id", "3 AS score", "4 AS rank").repartition(3)
    it = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "1 AS number", "2 AS id")
    assert rows_of(rank_documents(df, it, postings=postings)) == brute(docs, items, 10)


def test_item_blocks_and_empty_tables(spark, monkeypatch):
    rng = random.Random(8)
    docs, vocab = corpus(rng, 60)
    items = [(i, " ".join(rng.choices(vocab, k=4))) for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame(items, "item_id int, text string")
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 40)
    assert rows_of(rank_documents(df, it, k=3)) == brute(docs, items, 3)
    for left, right in ((df.limit(0), it), (df, it.limit(0)), (spark.createDataFrame([(1, "..")], df.schema), it)):
        got = rank_documents(left, right)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_long_text_in_parts(monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choices(["aa", "Bb,", "é" * 50, "c" * 3000], k=2000))
    want = Counter(t.encode() for t in terms(text))
    for part in (1, 100, 5000):
        monkeypatch.setattr(lexical_search, "PART", part)
        assert term_counts(text.encode()) == want
    assert term_counts(None) == Counter()


def test_stops_at_best_positions():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 5000, 6
    has = rng.random((n_docs, n_terms)) < 0.7
    impact = (rng.pareto(2.0, (n_docs, n_terms)) * 1000).astype(np.int64) + 1
    terms_of = [np.flatnonzero(row) for row in has]
    starts = np.r_[0, np.cumsum([len(t) for t in terms_of])]
    block = Block(starts, np.concatenate(terms_of), impact[has], n_terms)
    asked, times = np.array([0, 2, 5]), np.array([1, 3, 1])
    scores = (np.where(has, impact, 0)[:, asked] * times).sum(axis=1)
    order = np.lexsort((np.arange(n_docs), -scores))[:10]
    docs, got, looked = best_positions(block, asked, times, 10)
    assert docs.tolist() == order.tolist() and got.tolist() == scores[order].tolist()
    assert looked < n_docs / 4
    # Nothing is read where the k-th score is out of reach.
    assert best_positions(block, asked, times, 10, int(scores.max()) * 10)[2] == 0
    # Documents that equal the given score are still found.
    tied = best_positions(block, asked, times, 10, int(scores[order[4]]))
    assert tied[0].tolist() == order[:5].tolist()
