"""Toxicity scores: unseen spellings, lengths, defined cases."""

import random

import numpy as np
import pytest

from chatweave.llm import toxicity
from chatweave.llm.toxicity import SIZES, grams, score_toxicity, text_rows

WORDS = [a + b for a in ("lan", "mer", "tol", "vis", "gor", "pen") for b in ("ta", "ri", "do", "nel", "sum", "ka", "pir", "")]


def text(rng, n, bad=()):
    words = rng.choices(WORDS, k=n)
    for b in bad:
        words.insert(rng.randrange(len(words) + 1), b)
    return " ".join(words)


def table(rng, first, n, stems):
    rows = []
    for i in range(first, first + n):
        toxic = i % 4 == 0
        size = rng.choice([8, 40, 300])
        bad = [rng.choice(stems) + rng.choice(["o", "or", "ish"]) for _ in range(max(1, size // 20))] if toxic else []
        rows.append((i, text(rng, size, bad), int(toxic)))
    return rows


def test_unseen_spellings_are_found(spark):
    rng = random.Random(2)
    seen = table(rng, 0, 600, ["zwubbeq", "frixxat"])
    # Other endings and a doubled letter: no such word is in a training text.
    new = table(rng, 1000, 200, ["zwubbeqq", "frixxatt", "zwubbequ"])
    docs = spark.createDataFrame([r[:2] for r in seen + new], "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS label", "3 AS rows")
    labels = spark.createDataFrame([(r[0], r[2]) for r in seen], "doc_id bigint, toxic int").selectExpr("*", "7 AS id", "8 AS text")
    scores = {r.doc_id: r.score for r in score_toxicity(docs, labels).collect()}
    assert len(scores) == 800
    caught = np.mean([scores[i] >= 0.3 for i, _, t in new if t])
    wrong = np.mean([scores[i] >= 0.3 for i, _, t in new if not t])
    assert caught >= 0.9 and wrong <= 0.05
    again = {r.doc_id: r.score for r in score_toxicity(docs.repartition(5), labels.repartition(3)).collect()}
    assert again == pytest.approx(scores, rel=1e-6)


def test_grams_are_those_of_whole_words(monkeypatch):
    def slow(t):
        out = []
        padded = [" " + w + " " for w in "".join(c if c.isalnum() and ord(c) < 128 or ord(c) > 127 else " " for c in t).split()]
        for w in padded:
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            out += [w[i:i + n] for n in SIZES for i in range(len(w) - n + 1)]
        return out

    texts = ["", "I am, the Änderung!", "a", "..", "日本語 x-ray\nİ", "q" * 50]
    counts = {}
    for part in (5, 7, 1_000_000):
        monkeypatch.setattr(toxicity, "PART", part)
        per_text = [0] * len(texts)
        for rows, doc in grams(texts):
            for d in doc.tolist():
                per_text[d] += 1
        assert per_text == [len(slow(t)) for t in texts]
        counts[part] = [(a.tolist(), b.tolist()) for a, b in text_rows(texts)]
        assert [sum(b) for _, b in counts[part]] == per_text
    assert counts[5] == counts[7] == counts[1_000_000]
    known = {}
    for w in ("the", "then", "he", "other"):
        rows = np.concatenate([r for r, _ in grams([w])])
        assert len(rows) == len(slow(w))
        for g, r in zip(sorted(slow(w), key=len), rows.tolist()):
            assert known.setdefault(g, r) == r


def test_defined_cases(spark):
    rng = random.Random(3)
    rows = table(rng, 0, 80, ["zwubbeq"])
    docs = [r[:2] for r in rows] + [(500, None), (501, ""), (502, " .,"), (None, rows[0][1]), (0, rows[0][1]), (503, text(rng, 300_000))]
    labels = [(r[0], r[2]) for r in rows] + [(None, 1), (500, 1), (501, 0), (3, None), (3, 7), (9999, 1), (4, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    told = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = [(r.doc_id, r.score) for r in score_toxicity(df, told).collect()]
    assert len(got) == len(docs) and all(0 <= s <= 1 for _, s in got)
    by = {}
    for d, s in got:
        by.setdefault(d, []).append(s)
    assert by[500] == by[501] == by[502] and by[0][0] == by[0][1] == by[None][0]
    assert by[503][0] < 0.3
    assert score_toxicity(df.limit(0), told).count() == 0
    for few in (told.filter("toxic = 0"), told.limit(0)):
        same = {r.score for r in score_toxicity(df, few).collect()}
        assert len(same) == 1
