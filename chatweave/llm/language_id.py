"""Language ID by Bayesian evidence fusion.

Four kinds of evidence are multiplied, in logarithms:

- the text: naive Bayes over hashed byte trigrams, one model per language and one,
  ``und``, that expects every trigram alike (unknown scripts, noise). The evidence of n trigrams, which depend on
  each other, counts as that of ``n * K / (n + K)`` with K = ``MAX_TRIGRAMS``, at every length, so that long texts do not drown everything else;
- the declared markup language (or language column): how often it is given for each
  language, from grouped counts over the corpus, smoothed;
- the address suffix (the last label of the host): the same;
- the host: a prior over languages smoothed towards that of its suffix, and that
  towards the corpus. Counts are of what texts alone say, from grouped aggregation, without the row itself.

The text models are fitted on at most ``max_rows`` different labelled texts per language
(those of the lowest digest), for every declared language with at least ``min_texts`` different texts, whatever its share of the rows; the
label ``und`` is no language, and labels of fewer texts are taken for typing errors. All counts and priors come from all rows.

A row is rejected (``kept`` false) if it has no letter, if its best language is ``und``
or none of ``accept``, or if the best language's probability is below ``least``.

Defined cases: null text is empty and rejected, with language ``und``; null declarations, hosts
and suffixes carry no evidence; repeated rows and ids are judged one by one; an empty
table gives an empty table; texts of any length are read whole; a tie of two languages goes to the first by
name; extra columns are ignored, whatever their names.

How it runs: one pass over the texts leaves only scores, which are written to the shared folder;
counting and fusing work on those. Hosts are counted with map-side sums and joined back
through all-host tables no larger than the number of hosts; one frequent host makes one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatweave.llm.kept import let_go
from chatweave.operators.joins import bounded_broadcast
from chatweave.session import scratch_path, small_batches

BUCKETS = 1 << 16
MAX_TRIGRAMS = 200
MAX_ROWS = 500
MIN_TEXTS = 3
UNKNOWN = "und"
LETTER = r"\p{L}"


def buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of each byte trigram."""
    x = data.astype(np.uint32)
    return ((x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35))
            >> np.uint32(7)) & np.uint32(BUCKETS - 1)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)


def fit_text_model(rows: DataFrame, label: str, text: str, max_rows: int = MAX_ROWS, min_texts: int = MIN_TEXTS,
                   languages: tuple[str, ...] | None = None) -> tuple[list[str], np.ndarray]:
    """Languages and their log10 trigram weights, from at most ``max_rows`` different texts each."""
    known = rows.filter(F.col(label).isNotNull() & F.rlike(F.coalesce(F.col(text), F.lit("")), F.lit(LETTER)))
    labelled = known.select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    if languages is not None:
        labelled = labelled.filter(F.col("label").isin(list(languages)))
    # Digests up to a bound that leaves a few times max_rows texts of each label, so that no label makes a hot window.
    sizes = labelled.filter(F.col("label") != UNKNOWN).groupBy("label").agg(F.approx_count_distinct("digest").alias("texts"))
    bound = F.least(F.lit(1.0), F.lit(3.0 * max_rows) / F.col("texts"))
    sizes = sizes.filter(F.col("texts") >= 0.8 * min_texts).select("label", bound.alias("bound"))
    near = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < F.col("bound") * F.lit(float(1 << 30))
    some = labelled.join(bounded_broadcast(sizes), "label").filter(near).select("label", "digest").distinct()
    order = Window.partitionBy("label").orderBy(F.xxhash64("digest"), "digest")
    chosen = (some.withColumns({"n": F.row_number().over(order), "all": F.count(F.lit(1)).over(Window.partitionBy("label"))})
              .filter((F.col("n") <= max_rows) & (F.col("all") >= min_texts)).select("label", "digest"))
    sample = labelled.join(bounded_broadcast(chosen), ["label", "digest"]).dropDuplicates(["label", "digest"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[x] = seen.get(x, 0.0) + np.bincount(buckets(_bytes(t)), minlength=BUCKETS)
        for x, n in seen.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], ["label", "bucket", "n"])

    # At most BUCKETS counts per language.
    with small_batches(rows.sparkSession):
        found = (sample.select("label", "text").mapInArrow(count, "label string, bucket int, n double")
                 .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow())
    labels = found.column("label").to_pylist()
    names = sorted(set(labels) | set(languages or ()))
    place = {x: i for i, x in enumerate(names)}
    table = np.full((BUCKETS, len(names) + 1), 0.05)
    table[found.column("bucket").to_numpy(), [place[x] for x in labels]] += found.column("n").to_numpy()
    table[:, -1] = 1.0  # und: every trigram alike
    return [*names, UNKNOWN], np.log10(table / table.sum(axis=0))


def _scored(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """rows (key, text, ...others) with ``scores`` in place of the text."""
    n_lang = table.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = batch.column(0)
            out = np.zeros((batch.num_rows, n_lang))
            for i in range(batch.num_rows):
                data = _bytes(texts[i].as_py())
                if len(data) > 2:
                    seen = np.bincount(buckets(data), minlength=BUCKETS)
                    at = np.nonzero(seen)[0]
                    out[i] = seen[at] @ table[at] * (MAX_TRIGRAMS / (MAX_TRIGRAMS + len(data) - 2))
            flat = pa.array(out.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, n_lang), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], [*batch.schema.names[1:], "scores"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[1:])
    return rows.mapInArrow(run, f"{kinds}, scores array<double>")


def _share(n: Column, parent: Column, total: Column, weight: float) -> Column:
    """Smoothed share: counts with ``weight`` rows' worth of the parent's share."""
    return (n + weight * parent) / (total + weight)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             declared: Column | None = None, host: Column | None = None, *, accept: tuple[str, ...] | None = None,
             least: float = 0.5, weight: float = 5.0) -> DataFrame:
    """Per row: the id, ``text_lang`` (text alone), ``language``, ``probability`` and ``kept``."""
    spark = docs.sparkSession
    names, table = model
    none = F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col), F.lit(""))
    host = F.lower(host) if host is not None else none
    suffix = F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))
    rows = docs.select(text.alias("text"), F.col(id_col).alias("id"),
                       (declared if declared is not None else none).alias("declared"),
                       host.alias("host"), suffix.alias("suffix"), F.rlike(text, F.lit(LETTER)).alias("letters"))
    path = scratch_path(spark, "language-scores")
    best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
    with small_batches(spark):
        _scored(rows, table).withColumn("best", best).write.parquet(path)
    scored = spark.read.parquet(path)

    said = scored.filter("letters")
    one_hot = [F.sum(F.when(F.col("best") == i, 1.0).otherwise(0.0)) for i in range(len(names))]

    def counts(key: str, *more: str) -> DataFrame:
        """Per key: texts of each language."""
        return said.groupBy(key, *more).agg(F.array(*one_hot).alias(f"{key}_n"))

    whole = said.agg(F.array(*one_hot).alias("n")).first()["n"]
    whole = [x or 0.0 for x in whole] if whole else [0.0] * len(names)
    total = sum(whole)
    top = F.array(*[F.lit((x + 1 / len(names)) / (total + 1)) for x in whole])
    langs = F.array(*[F.lit(i) for i in range(len(names))])

    def joined(df: DataFrame, key: str) -> DataFrame:
        found = counts(key).filter(F.col(key).isNotNull())
        return df.join(bounded_broadcast(found), key, "left")

    fused = joined(joined(joined(scored, "host"), "suffix"), "declared")
    own = F.transform(langs, lambda i: F.when(F.col("letters") & (F.col("best") == i), 1.0).otherwise(0.0))
    zeros = F.array(*[F.lit(0.0) for _ in names])

    def less_own(key: str) -> Column:
        return F.when(F.col(f"{key}_n").isNull(), zeros).otherwise(
            F.zip_with(f"{key}_n", "own", lambda a, b: a - b))

    def add(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    fused = (fused.withColumn("own", own)
             .withColumns({f"{k}_c": less_own(k) for k in ("host", "suffix", "declared")})
             .withColumns({f"{k}_t": add(F.col(f"{k}_c")) for k in ("host", "suffix")}))
    below = F.zip_with("suffix_c", top, lambda n, p: _share(n, p, F.col("suffix_t"), weight))
    prior = F.zip_with("host_c", below, lambda n, p: _share(n, p, F.col("host_t"), weight))
    # P(declared | language) up to a factor that is the same for all languages of the row.
    given = F.zip_with("declared_c", F.array(*[F.lit(x) for x in whole]), lambda n, t: (n + 0.5) / (t + 0.5 * len(names)))
    seen = F.when(F.col("declared").isNull(), zeros).otherwise(F.transform(given, lambda x: F.log10(x)))
    power = F.zip_with(F.zip_with("scores", F.transform(prior, lambda x: F.log10(x)), lambda a, b: a + b),
                       seen, lambda a, b: a + b)
    at = fused.withColumn("power", power).withColumn("most", F.array_max("power"))
    at = at.withColumn("probability", 1 / add(F.transform("power", lambda x: F.pow(F.lit(10.0), x - F.col("most")))))
    name = F.array(*[F.lit(x) for x in names])
    chosen = F.when(F.col("letters"), F.get(name, F.array_position("power", F.col("most")).cast("int") - 1)).otherwise(UNKNOWN)
    ok = F.col("language").isin(list(accept)) if accept else F.col("language") != UNKNOWN
    return (at.withColumn("language", chosen)
            .select(F.col("id").alias(id_col), F.when(F.col("letters"), F.get(name, F.col("best"))).otherwise(UNKNOWN)
                    .alias("text_lang"), "language", "probability",
                    (F.col("letters") & ok & (F.col("probability") >= least)).alias("kept")))


def page_text(html: Column) -> Column:
    """The visible text of a page, roughly: without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[#\w]+;", " ")


def page_language(html: Column) -> Column:
    """The language that the markup declares, in lower case without its region."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)""", 1))
    return F.when(found != "", found)


def page_host(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.when(found != "", found)
