"""Packing, token counts, Jaccard join, scoring, decontamination, language ID and the pipeline."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chatweave.llm import jaccard_join, language_id, lattice_score
from chatweave.llm.components import connected
from chatweave.llm.decontaminate import drop_contaminated, find_items
from chatweave.llm.jaccard_join import near_duplicates
from chatweave.llm.language_id import fit_text_model, identify, page_host, page_language
from chatweave.llm.lattice_score import score_documents
from chatweave.llm.packing import BestFit, pack_documents
from chatweave.llm.token_count import count_merges, count_tokens

DOCS = "doc_id bigint, text string"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n\t", "Hello, world!  It's 2024.", "x<|endoftext|>y <|startoftext|>", "é́ İ 喋喋 한 \U0001f642",
       "a" * 5000, "don't DON'T 'S", "՘՘ क्ष", "a b c\x85d\x1ce", "word " * 3000]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_merges_by_hand():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2}
    assert count_merges(list("abc"), ranks) == 2
    assert count_merges(list("aaab"), {("a", "a"): 0, ("aa", "a"): 1}) == 2
    assert count_merges([], ranks) == 0 and count_merges(["a"], ranks) == 0


def test_token_counts(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTE_BPE)
    rows = list(enumerate(ODD)) + [(0, None), (None, "a b")]
    df = docs_of(spark, rows).withColumn("n_tokens", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in count_tokens(df, BYTE_BPE).collect())
    assert got == sorted((str(i), len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    fit = BestFit(10, 2)
    assert [fit.place(x) for x in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]
    assert fit.closed == [1]
    assert fit.place(9) == (2, 0) and fit.place(8) == (3, 0) and fit.closed == [1, 2]


@pytest.mark.parametrize("capacity,bins", [(4096, 512), (50, 2), (1, 1)])
def test_packing(spark, capacity, bins):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORD_BPE)
    texts = ODD if capacity > 1 else ODD[:6]
    rows = list(enumerate(texts)) + [(0, None), (None, "word")]
    out = pack_documents(docs_of(spark, rows).withColumn("ids", F.lit(1)).repartition(3), WORD_BPE, capacity=capacity, open_bins=bins, regroup=2).collect()
    want = Counter()
    for i, t in rows:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at:at + capacity]
            want[i, p, at, len(cut), struct.pack(f"<{len(cut)}I", *cut)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in out) == want
    filled = defaultdict(list)
    for r in out:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert count_tokens(none, BYTE_BPE).count() == 0
    assert pack_documents(none, WORD_BPE).count() == 0
    assert near_duplicates(none).count() == 0
    assert score_documents(none, PIECES).count() == 0
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id int, text string")
    assert find_items(none, items).count() == 0 and find_items(docs_of(spark, [(1, "a b c d e f")]), items.limit(0)).count() == 0
    labelled = none.withColumn("lang", F.lit("en"))
    assert identify(labelled, fit_text_model(labelled, "lang", "text"), declared=F.col("lang")).count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else (frozenset([tuple(w)]) if w else frozenset())


def brute_groups(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def copies(seed, n_docs, size, edits, shared):
    """Near copies of a few texts with a growing number of edits, and a passage in all of them."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(shared)]
    base = [[f"b{k}w{i}" for i in range(size)] for k in range(3)]
    rows = []
    for i in range(n_docs):
        text = list(base[i % 3])
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**9)}"
        rows.append((1000 - i, " ".join(passage + text + [f"t{rng.randrange(3)}" for _ in range(rng.randrange(size // 8 + 1))])))
    return rows


@pytest.mark.parametrize("rows", [
    [(1, "a b c"), (2, "A  b\tC"), (3, None), (4, " "), (5, None), (6, "a b"), (None, "a b c"), (None, "z z z z z z"), (7, "q"), (7, "q")],
    copies(1, 60, 60, 4, 0), copies(2, 60, 250, 12, 60), copies(3, 40, 64, 3, 20), copies(4, 24, 1100, 60, 10), copies(5, 60, 12, 1, 3),
])
def test_jaccard_against_brute_force(spark, rows, monkeypatch):
    for block in (4096, 7):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        df = docs_of(spark, rows).withColumn("key", F.lit(1)).withColumn("n", F.lit("n"))
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=str)
        assert got == brute_groups(rows)


def test_pairs_under_keys_of_few_classes_are_counted(spark, monkeypatch):
    """Groups that are left apart by the first class of their keys need no sketches in a shuffle."""
    def refuse(threshold, limit):
        def run(batches):
            for batch in batches:
                assert not batch.num_rows, "rows with sketches"
            yield from ()

        return run

    rows = copies(2, 24, 250, 12, 60)
    with monkeypatch.context() as patch:
        patch.setattr(jaccard_join, "_emit_edges", refuse)
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, rows)).collect()), key=str)
    assert got == brute_groups(rows)


@pytest.mark.parametrize("few", [1, 3])
def test_keys_of_few_and_many_classes_together(spark, few, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    rows = copies(3, 40, 64, 3, 20)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, rows)).collect()), key=str)
    assert got == brute_groups(rows)


def doubled(size):
    """Words of ``size`` letters a and b that collide under any hash by powers of one odd number."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [32, 64, 512, 1024, 4096])
def test_words_of_one_pattern_stay_apart(spark, size):
    one, two = doubled(size)
    rows = [(1, " ".join([one] * 6 + ["x"])), (2, " ".join([two] * 6 + ["x"])), (3, f"{one} y"), (4, f"{two} y"), (5, f"{one} y")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, rows)).collect()), key=str)
    assert got == brute_groups(rows)
    hashes = jaccard_join.word_hashes(f"{one} {two}".encode())[0]
    assert hashes[0] != hashes[1]


def test_large_group_of_near_copies(spark):
    """Thousands of different texts near one text, and as many that only share a passage with it."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows, passage = [], [f"p{i}" for i in range(25)]
    for i in range(5000):
        text = list(base)
        text[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(text)))
    for i in range(1500):
        rows.append((10_000 + i, " ".join([*passage, *(f"o{i}w{j}" for j in range(100))])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, rows).repartition(8)).collect()}
    # Each copy links to all whose edit is near its own, and so to the whole group.
    assert {c for i, (_, c) in got.items() if i < 5000} == {0}
    assert all(got[10_000 + i] == (121, 10_000 + i) for i in range(1500))


def test_keys_meet_for_every_link():
    """The pigeonhole bound, for sizes around the ends of the bands."""
    rng = np.random.default_rng(7)
    for n in (1, 3, 4, 5, 13, 15, 16, 17, 51, 63, 64, 80, 255, 256, 300, 1023, 1025):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**64, n, np.uint64))
            drop = rng.integers(0, n // 5 + 1)
            kept = rng.permutation(a)[drop:]
            b = np.unique(np.r_[kept, rng.integers(0, 2**64, rng.integers(0, n // 4 + 1), np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            frequent = np.sort(rng.permutation(a)[: n // 2])
            met = False
            for level in set(jaccard_join.levels(len(a), 80)) & set(jaccard_join.levels(len(b), 80)):
                (x, least), (y, least_y) = (jaccard_join.keys_of(s, level, frequent, 80) for s in (a, b))
                met = met or len(set(x.tolist()) & set(y.tolist())) >= max(least, least_y)
                p, q = (np.frombuffer(jaccard_join.parity_bits(s, level), np.uint8) for s in (a, b))
                assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(a, b))
            assert met


@pytest.mark.parametrize("local", [0, 300_000])
def test_components(spark, local):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (200, 200), (7, 3), (60 + 1, 60)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u int, v int"), local_edges=local).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 103: 100, 60: 60, 61: 60}


@pytest.mark.parametrize("head", [200_000, 3])
def test_scores_against_brute_force(spark, head):
    rows = [(i, f"The cat {i} sat\nthe état {'x' * (i % 4)}日") for i in range(20)] + [(3, None), (None, "the"), (90, "z" * 3000)]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    train = Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            train.update(lattice_score.tokens(t or ""))
    n, v = sum(train.values()), len(train)
    table = spark.createDataFrame([(bytearray(w), c) for w, c in train.items()], "word binary, c bigint")
    weights = lattice_score.fit_pieces(table, PIECES)
    assert np.exp(weights).sum() == pytest.approx(1)
    scores = lattice_score.Scores(PIECES, n, v, weights)
    out = sorted(score_documents(docs_of(spark, rows).withColumn("key", F.lit(1)), PIECES, head=head).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    want = sorted(zip(rows, held), key=lambda x: (str(x[0][0]), len(lattice_score.tokens(x[0][1] or ""))))
    for r, ((doc, text), h) in zip(out, want, strict=True):
        ws = lattice_score.tokens(text or "")
        assert (r.doc_id, r.held_out, r.n_tokens, r.train_tokens) == (doc, h, len(ws), n)
        assert r.n_known == sum(train[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score == pytest.approx(sum(scores.full([w], np.array([float(train[w])]))[0] for w in ws))


def test_lattice_sums_all_segmentations():
    grid = lattice_score.lattice(PIECES)
    weights = np.log(grid.start)
    pieces = {}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i in range(model.get_piece_size()):
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)):
            pieces.setdefault(model.id_to_piece(i), len(pieces))

    def total(text):
        if not text:
            return 1.0
        s = sum(math.exp(weights[pieces[text[:k]]]) * total(text[k:]) for k in range(1, len(text) + 1) if text[:k] in pieces)
        if text[0] not in pieces:
            s += math.exp(sum(weights[len(pieces) + b] for b in text[0].encode())) * total(text[1:])
        return s

    words = ["the", "internat", "a", "\U00012345x", "été"]
    got = grid.spellings([w.encode() for w in words], weights)
    assert np.exp(got) == pytest.approx([total(lattice_score.MARK + w) for w in words])
    uses = grid.expected([w.encode() for w in words], weights)
    assert uses[pieces[lattice_score.MARK + "the"]] > 0 and len(words) <= uses.sum()


def test_held_out_text_is_likelier_with_its_own_corpus(spark):
    own = [(i, f"alpha beta gamma delta {i}") for i in range(60)]
    got = score_documents(docs_of(spark, own), PIECES).filter("held_out").agg(F.avg(F.col("score") / F.col("n_tokens"))).first()[0]
    other = [(i, f"entirely different words here {i}" if zlib.crc32(str(i).encode()) % 7 != 2 else t) for i, t in own]
    worse = score_documents(docs_of(spark, other), PIECES).filter("held_out").agg(F.avg(F.col("score") / F.col("n_tokens"))).first()[0]
    assert worse < got < 0


def test_items_are_found_exactly(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 10, 14, 15, 24, 60, 200])] + [(90, None), (91, " "), (3, "x y z x y z x y")]
    docs = [(None, items[8][1]), (5, None), (5, items[3][1]), (5, items[3][1].upper())]
    for k in range(160):
        i, text = items[rng.randrange(11)]
        words = text.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "other"
        docs.append((100 + k, " ".join(f"d{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 2000]))) + " " + " ".join(words)))
    df = docs_of(spark, docs).withColumn("hash", F.lit(1)).withColumns({"_row": F.lit("mine"), "key": F.lit(2), "row": F.lit(3), "hit": F.lit(4)})
    it = spark.createDataFrame(items, "item_id int, text string")
    got = Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in find_items(df, it).collect())
    want = Counter()
    for d, t in docs:
        for i, x in items:
            a, b = shingles(x), shingles(t)
            if a and 100 * len(a & b) >= 80 * len(a):
                want[d, i, len(a), len(a & b)] += 1
    assert got == want and len(want) > 40
    kept = drop_contaminated(df, it)
    assert kept.columns == df.columns
    # Rows are judged, not ids: a clean row stays beside a contaminated one of the same id.
    asked = [shingles(x) for _, x in items if shingles(x)]
    clean = Counter((d, t) for d, t in docs if not any(100 * len(a & shingles(t)) >= 80 * len(a) for a in asked))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == clean and clean[5, None] == 1
    assert {r["_row"] for r in kept.collect()} == {"mine"}


TEXTS = {"en": "the house and the garden with a tree near water", "de": "das haus und der garten mit einem baum am wasser",
         "fr": "la maison et le jardin avec un arbre pres de leau"}


def test_language_evidence(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.sample(TEXTS[x].split(), 6)), x, f"{x}.example.{'com' if x == 'en' else x}") for i, x in enumerate(rng.choices(list(TEXTS), k=300))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, host string").withColumn("scores", F.lit(1))
    model = fit_text_model(df.filter("doc_id < 150"), "lang", "text")
    got = {r.doc_id: r for r in identify(df, model, declared=F.col("lang"), host=F.col("host")).collect()}
    assert sum(got[i].language == x for i, _, x, _ in rows) >= 298 and all(r.kept for r in got.values())
    # Held-out rows by text alone.
    alone = {r.doc_id: r for r in identify(df, model).collect()}
    assert sum(alone[i].text_lang == x for i, _, x, _ in rows if i >= 150) >= 145
    # A text that could be either goes with its host, its declaration and its suffix.
    odd = [(1000, "q", None, "de.example.de"), (1001, "q", "fr", None), (1002, "q", None, "new.fr"), (1003, None, "en", "x"), (1004, "12 34", "en", "x"),
           (1005, "日本語の文章です。これは誰にも読めない" * 5, None, None), (1000, "q", None, "de.example.de")]
    more = df.drop("scores").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string, lang string, host string"))
    got = {r.doc_id: r for r in identify(more, model, declared=F.col("lang"), host=F.col("host")).collect()}
    assert [got[i].language for i in (1000, 1001, 1002)] == ["de", "fr", "fr"]
    assert [got[i].kept for i in (1003, 1004, 1005)] == [False, False, False]


def test_language_text_evidence_against_brute_force(spark):
    """Text scores and fused probabilities of every length against plain Python."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(TEXTS[x].split(), k=5)), x) for i, x in enumerate(rng.choices(list(TEXTS), k=120))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, table = fit_text_model(df, "lang", "text")
    counts = {x: np.full(language_id.BUCKETS, 0.05) for x in TEXTS}
    for t, x in {(t, x) for _, t, x in rows}:
        for b in language_id.buckets(np.frombuffer(f" {t.lower()} ".encode(), np.uint8)).tolist():
            counts[x][b] += 1
    assert names == [*sorted(TEXTS), "und"]
    for i, x in enumerate(sorted(TEXTS)):
        assert table[:, i] == pytest.approx(np.log10(counts[x] / counts[x].sum()))
    odd = [(1000 + n, ("the haus " * n)[:max(0, n - 0)], None) for n in (1, 5, 198, 199, 200, 201, 20_000)]
    more = df.unionByName(spark.createDataFrame(odd, df.schema))
    got = {r.doc_id: r for r in identify(more, (names, table)).collect()}
    said, scores = Counter(), {}
    for i, t, _ in [*rows, *odd]:
        b = language_id.buckets(np.frombuffer(f" {t.lower()} ".encode(), np.uint8))
        scores[i] = table[b].sum(axis=0) * language_id.MAX_TRIGRAMS / (language_id.MAX_TRIGRAMS + len(b))
        said[int(scores[i].argmax())] += 1
    for i, _, _ in [*rows, *odd]:
        # Without hosts the prior is the share of the languages, less what the row itself says of no host: all of it.
        top = np.array([(said[k] + 1 / len(names)) / (sum(said.values()) + 1) for k in range(len(names))])
        power = scores[i] + np.log10(top)
        p = 1 / (10 ** (power - power.max())).sum()
        assert got[i].text_lang == names[int(scores[i].argmax())] and got[i].language == names[int(power.argmax())]
        assert got[i].probability == pytest.approx(p)


def test_thousands_of_labels(spark):
    """A column of labels with typing errors: those of too few texts are no languages."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(TEXTS[x].split(), k=6)), x) for i, x in enumerate(rng.choices(list(TEXTS), k=3000))]
    rows += [(10_000 + i, f"word{i} other{i}", f"label {i}") for i in range(5000)]
    rows += [(20_000 + i, "the same text each time", "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, table = fit_text_model(df, "lang", "text", max_rows=100)
    assert names == ["de", "en", "fr", "und"] and table.shape == (language_id.BUCKETS, 4)
    got = {r.doc_id: r.language for r in identify(df, (names, table), declared=F.col("lang")).filter("doc_id < 3000").collect()}
    assert sum(got[i] == x for i, _, x in rows[:3000]) >= 2950


def test_page_parts(spark):
    df = spark.createDataFrame([('<!doctype html><HTML class="x" LANG=\'De-AT\'>', "HTTPS://u@Www.Site.DE:80/p?x"), ("<p>", "no url"), (None, None)], "h string, u string")
    got = df.select(page_language(F.col("h")), page_host(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("de", "www.site.de"), (None, None), (None, None)]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    def text(k, n=60):
        return " ".join(f"{w}{k}" for w in rng.choices(TEXTS["en"].split(), k=n))
    item, line = text("q", 30), "a line that is repeated in documents"
    rows = [(i, text(i), "en", "s") for i in range(20)]
    rows += [(20, rows[3][1], "en", "s"), (21, rows[4][1] + " end", "en", "s"), (22, text(22) + " " + item + " " + text(23), "en", "s"), (23, None, "en", "s")]
    rows += [(30 + i, f"{text(30 + i)}\n{line}", "en", None) for i in range(4)]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    left = {r.doc_id: r for r in docs.collect()}
    assert set(left) == {r[0] for r in rows} - {20, 21, 22, 23}
    assert [line in left[30 + i].text for i in range(4)] == [False, False, False, True]
    assert all(r.n_chars == len(r.text) for r in left.values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(left) and len({r.sequence_id for r in packed}) == 1
