"""Languages of a small share of the rows."""

import random

from pyspark.sql import functions as F

from chatweave.llm.language_id import fit_text_model, identify

WORDS = {"en": "the house and the garden with a tree near water", "ru": "дом и сад с большим деревом у самой воды",
         "zh": "房子 和 花园 里 有 一棵 大树 靠近 河水 边"}


def test_rare_languages_are_fitted(spark):
    rng = random.Random(3)
    langs = ["en"] * 990 + ["ru"] * 5 + ["zh"] * 5
    rows = [(i, " ".join(rng.sample(WORDS[x].split(), 7)), x) for i, x in enumerate(langs)]
    rows += [(2000 + i, "ᚠᚢᚦᚨᚱᚲᚷᚹᚺᚾᛁᛃᛇᛈ" * 5, None) for i in range(3)] + [(3000, rows[0][1], "und")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit_text_model(df, "lang", "text")
    assert model[0] == ["en", "ru", "zh", "und"]
    got = {r.doc_id: r for r in identify(df, model, declared=F.col("lang")).collect()}
    assert all(got[i].kept and got[i].language == x for i, x in enumerate(langs))
    assert not any(got[2000 + i].kept for i in range(3)) and got[3000].language == "en"
