"""Stage decisions hold for rows, also where ids are null or repeat."""

import random
from collections import Counter

import corpus_pipeline

WORDS = "the house and the garden with a tree near water".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], SCHEMA)


def texts(k, n=60):
    rng = random.Random(k)
    return " ".join(f"{w}{k}" for w in rng.choices(WORDS, k=n))


def left(docs):
    return Counter((r.doc_id, r.text) for r in docs.collect())


def test_language_and_benchmark_keep_clean_rows_of_an_id(spark, tmp_path):
    item = texts(99, 30)
    clean = [(None, texts(1)), (None, texts(2)), (7, texts(3)), (8, texts(4))]
    blank = [(None, None), (None, " "), (7, "12 34")]
    df = docs_of(spark, clean + blank)
    assert left(corpus_pipeline.language(spark, df, "")) == Counter(clean)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaks = [(None, f"{texts(5)} {item}"), (7, f"{item} {texts(6)}"), (7, f"{item} {texts(6)}")]
    kept = corpus_pipeline.benchmark(spark, docs_of(spark, clean + blank + leaks), str(tmp_path))
    assert left(kept) == Counter(clean + blank) and kept.columns == df.columns


def test_near_keeps_one_row_of_each_group(spark):
    a, b, c, d = (texts(k) for k in (1, 2, 3, 4))
    near = [(None, a), (None, a + " end"), (None, a)]  # null ids only
    mixed = [(None, b), (5, b + " end"), (9, b)]  # the least id, null ids last
    same = [(7, c), (7, c), (7, c)]  # equal in all columns
    one = [(8, d), (8, d + " end"), (8, texts(5))]  # one id, a group and another text
    blank = [(3, None), (3, None), (None, ""), (None, "")]  # in no group
    df = docs_of(spark, near + mixed + same + one + blank)
    got = left(corpus_pipeline.near(spark, df, ""))
    assert sum(n for (i, t), n in got.items() if t in (a, a + " end")) == 1
    assert sum(n for (i, t), n in got.items() if t in (d, d + " end")) == 1
    rest = Counter({k: n for k, n in got.items() if k[1] not in (a, a + " end", d, d + " end")})
    assert rest == Counter([(5, b + " end"), (7, c), (8, texts(5)), *blank])
