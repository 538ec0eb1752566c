"""The audit of filters against brute force, over several files and calls."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from chatweave.llm.filter_audit import audit_filters

DOCS = "doc_id bigint, text string, source string, key int, mask int, n int, part int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(x for x, bad in (
        ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search("[#$%&*|]", text)))) if bad)


def brute(docs, labels):
    order = lambda i: (i is None, i or 0)
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", (True, 1)), order(i))
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    rows = [(s or "", i, fails(t or "") + ("E" if order(i) > least[t or ""] else "")) for i, t, s in docs]
    out = {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        shapley = Counter()
        cells = defaultdict(Counter)
        for p in map("".join, permutations("ABCDE")):
            for step, f in enumerate(p, 1):
                c = cells[p, step]
                for i, bad in own:
                    earlier = set(p[:step - 1]) & set(bad)
                    c["kept"] += not set(p[:step]) & set(bad)
                    removed = f in bad and not earlier
                    c["removed"] += removed
                    c["redundant"] += f in bad and bool(earlier)
                    c["unique_fails"] += bad == f
                    c["good_lost"] += removed and i in good
                    c["toxic_lost"] += removed and i in toxic
                shapley[f] += c["removed"]
        for (p, step), c in cells.items():
            out[part, p, step] = (*(c[k] for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), shapley[p[step - 1]])
    return out


def rows_of(df):
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[k] for k in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}
    assert len(got) == df.count()
    return got


def corpus(rng):
    texts = [None, "", " \t\n", "a b", "X y | z", " ".join(f"w{i}" for i in range(60)), " ".join(["w w"] * 40), "É" * 30,
             " ".join(f"W{i} #" for i in range(50)), "x " * 20_000]
    ids = rng.sample(range(2**53, 2**53 + 400), 90)
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", None, "hot", "hot"])) for i in ids]
    docs += [(None, "a b", "s"), (None, "a b", "t"), (None, "alone", "s"), (docs[3][0], docs[3][1], docs[3][2]), (docs[3][0], docs[3][1], "s")]
    docs += [(docs[4][0], "another text", "s")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in ids[:60] for _ in range(rng.choice([1, 2]))]
    return docs, labels + [(None, 1, 1), (5, 1, 1)]


def write(spark, docs, path, files):
    for k in range(files):
        part = [(*d, 1, 2, 3, 4) for d in docs[k::files]]
        spark.createDataFrame(part, DOCS).repartition(1).write.mode("append").parquet(path)


def test_counts_follow_smaller_ids(spark, tmp_path):
    rng = random.Random(4)
    docs, labels = corpus(rng)
    told = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    # Falling ids: each later file takes the smallest id of a text away from an earlier one.
    docs.sort(key=lambda d: -(d[0] or 2**60))
    path, work = str(tmp_path / "docs"), str(tmp_path / "work")
    write(spark, docs[:50], path, 3)
    assert rows_of(audit_filters(spark, path, told, batches=3, work=work)) == brute(docs[:50], labels)
    write(spark, docs[50:], path, 3)
    assert rows_of(audit_filters(spark, path, told, batches=3, work=work)) == brute(docs, labels)
    events = spark.read.parquet(f"{work}/events")
    assert events.filter("delta < 0").count() > 3
    assert rows_of(audit_filters(spark, path, told, batches=1)) == brute(docs, labels)


def test_empty_tables(spark, tmp_path):
    empty, some = str(tmp_path / "empty"), str(tmp_path / "some")
    told = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    spark.createDataFrame([], DOCS).write.parquet(empty)
    assert audit_filters(spark, empty, told).count() == 0
    docs = [(1, "a", "s"), (2, "a", None)]
    write(spark, docs, some, 1)
    assert rows_of(audit_filters(spark, some, told)) == brute(docs, [])
