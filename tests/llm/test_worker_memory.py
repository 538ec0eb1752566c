"""What a Python worker holds: small batches, small parts, and nothing of the operator before."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chatweave.llm import jaccard_join, kept, language_id, packing
from chatweave.session import BATCH_CONF, small_batches


def test_batches_are_small_and_the_setting_goes(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(300, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    with small_batches(spark):
        texts.mapInArrow(sizes, "n long").write.parquet(str(tmp_path / "small"))
    assert BATCH_CONF not in spark.conf.getAll
    found = pq.read_table(tmp_path / "small").column("n").to_pylist()
    assert sum(found) >= 30_000_000 and max(found) < 9_000_000
    spark.conf.set(BATCH_CONF, "1m")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH_CONF) == "1m"
        assert spark.conf.get(BATCH_CONF) == "1m"
    finally:
        spark.conf.unset(BATCH_CONF)


def test_stages_run_with_small_batches(spark, monkeypatch):
    seen = []
    for module in (jaccard_join, language_id, packing):
        def noted(session, module=module):
            seen.append(module)
            return small_batches(session)
        monkeypatch.setattr(module, "small_batches", noted)
    docs = spark.createDataFrame([(i, f"some words of text number {i}", "en") for i in range(9)], "doc_id long, text string, lang string")
    language_id.identify(docs, language_id.fit_text_model(docs, "lang", "text")).collect()
    jaccard_join.near_duplicates(docs).collect()
    packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert {jaccard_join, language_id, packing} == set(seen)


@pytest.mark.parametrize("run", [
    jaccard_join._members("bigint")[0], jaccard_join._emit_keys(None, 80), jaccard_join._emit_sets(None, 80)])
def test_the_join_runs_without_the_ids_that_packing_remembers(run, monkeypatch):
    class Shipped:
        value = None

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = packing.chunk_ids(path)
    assert packing.chunk_ids(path) is ids
    for cell in run.__closure__ or ():
        if cell.cell_contents is None:
            cell.cell_contents = Shipped
    assert list(run(iter([]))) == []
    assert not kept._KEPT


def test_sets_of_many_texts_take_little_memory():
    texts = [" ".join(f"w{i * 7919 + k}" for k in range(400)) for i in range(1_000)]
    tracemalloc.start()
    try:
        made = sum(len(s) for s in jaccard_join.shingle_sets(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made == 396_000
    assert peak < 20_000_000
