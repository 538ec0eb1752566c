"""Operators with a plan for small and one for large inputs give the same rows on both."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chatweave.operators import inventory as inv
from chatweave.operators import sampling
from chatweave.operators.canonical import exchanges, nest_messages
from chatweave.operators.inference import GenerationOptions, batched_map, infer
from chatweave.operators.ordered import head_slice
from chatweave.operators.sampling import nucleus, top_k
from chatweave.operators.sessions import last_message_rows, session_state, turn_context
from chatweave.operators.vocabulary import decode, encode, fit_vocabulary
from chatweave.plans.artifacts import artifact_report
from chatweave.plans.prepare import conversation_tokens
from chatweave.sources.artifacts import list_artifacts, read_configs
from chatweave.sources.tables import publish


def plain(rows):
    return sorted((tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("keys", [
    [None, None, 1, 2, 2, 2, 3], list(range(50)), [None] * 6, [5] * 9, [None, -3, 2**40, 0, 0]])
def test_head_slice_routes(spark, keys):
    df = spark.createDataFrame([(k, str(i)) for i, k in enumerate(keys)], "k bigint, v string")
    for n in sorted({0, 1, 3, 4, len(keys) - 1, len(keys), len(keys) + 1}):
        few, many = head_slice(df, ["k"], n), head_slice(df, ["k"], n, in_one_task=0)
        assert plain(few.select("k").collect()) == plain(many.select("k").collect())
        # Of equal keys any rows may come, but each once.
        assert many.distinct().count() == many.count()
    two = df.withColumn("d", F.when(F.col("k") > 1, F.lit(float("nan"))).otherwise(1.5))
    few, many = head_slice(two, ["d", "k"], 4), head_slice(two, ["d", "k"], 4, in_one_task=0)
    assert plain(few.select("d", "k").collect()) == plain(many.select("d", "k").collect())


def test_top_k_and_nucleus_routes(spark, monkeypatch):
    rows = [(g, i, s) for g in (1, None) for i, s in enumerate([0.5, float("nan"), None, 5.0, 5.0, -1.0, None])]
    df = spark.createDataFrame(rows + [(2, i, float(i % 7)) for i in range(60)], "group_id bigint, cand bigint, score double")
    real = df.filter("score is not null and not isnan(score)")
    few = {k: plain(top_k(df, k).select("group_id", "cand", "rank").collect()) for k in (1, 3, 7, 100)}
    kept = {(k, p): plain(nucleus(real, 0.7, k, p).select("group_id", "cand").collect()) for k in (3, 100) for p in (0.3, 0.9, 1.0)}
    monkeypatch.setattr(sampling, "GROUP_LIMIT", 0)
    for k, want in few.items():
        assert plain(top_k(df, k, partitions=5).select("group_id", "cand", "rank").collect()) == want
    for (k, p), want in kept.items():
        assert plain(nucleus(real, 0.7, k, p, partitions=5).select("group_id", "cand").collect()) == want
    assert few[3][0][:2] == (1, 1)  # NaN is the highest number


def test_vocabulary_routes(spark):
    rows = [(1, ["a", "b"]), (1, ["b"]), (None, ["a", "zz", "b", "b"]), (None, []), (2, None), (3, [None, "a"])]
    df = spark.createDataFrame(rows, "key bigint, p array<string>")
    vocab = fit_vocabulary(df, "p", 2)
    assert [tuple(r) for r in vocab.orderBy("id").collect()] == [("b", 3, 4), ("a", 4, 3)]
    a, b = (encode(df, "key", "p", vocab, "ids", limit=n) for n in (10, 0))
    assert plain(a.collect()) == plain(b.collect())
    assert plain(decode(a, "key", "ids", vocab).collect()) == plain(decode(a, "key", "ids", vocab, limit=0).collect())


def test_fit_vocabulary_ties_at_the_threshold(spark):
    df = spark.createDataFrame([(["a"] * 5 + list("bcdefg") * 2 + ["h"],)], "p array<string>")
    assert [r.piece for r in fit_vocabulary(df, "p", 4).orderBy("id").collect()] == ["a", "b", "c", "d"]
    assert fit_vocabulary(df, "p", 100).count() == 8 and fit_vocabulary(df.limit(0), "p", 3).count() == 0


@pytest.mark.parametrize("shift", [0, -7, 10**12, -40])
def test_session_routes(spark, shift):
    kinds = ["hi", "/system be brief", "yes", "/clear", "more", "again", "last", "/exit", "late"]
    rows = [(c, shift + i * (1 if c else 3), kinds[i % 9 if c == 2 else i % 7], None if i % 5 == 4 else f"r{i}") for c in (1, 2, None, 0) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string, reply string")
    want = None
    for span in (1 << 60, 4096, 6):
        got = (plain(session_state(df, span=span).select("conv_id", "turn", "exits", "epoch", "sys", "k").collect()),
               plain(turn_context(df, max_messages=4, span=span).select("conv_id", "turn", F.to_json("messages")).collect()))
        want = want or got
        assert got == want
    for bad in (0, 3, -2):
        with pytest.raises(ValueError):
            turn_context(df, max_messages=bad)


def test_long_and_gappy_conversations(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(1500)]
    rows += [(2, t, r, f"x{t}") for t, r in ((-5, "user"), (0, "assistant"), (2000, "user"), (7, "user"), (4000, "user"), (4001, "assistant"))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = {r.conv_id: [m.content for m in r.messages] for r in nest_messages(df).collect()}
    assert whole[1] == [f"m{i}" for i in range(1500)] and whole[2] == ["x-5", "x0", "x7", "x2000", "x4000", "x4001"]
    last = {r.conv_id: [m.content for m in r.messages] for r in nest_messages(last_message_rows(df, n=4)).collect()}
    assert last[1] == ["m1496", "m1497", "m1498", "m1499"]
    pairs = {(r.turn, r.text): r.reply for r in exchanges(df.filter("conv_id = 2")).collect()}
    assert pairs == {(-5, "x-5"): "x0", (2000, "x2000"): None, (7, "x7"): None, (4000, "x4000"): "x4001"}
    out = {r.conv_id: r for r in conversation_tokens(df, 64).collect()}
    assert out[2].n_messages == 6 and out[2].n_tokens == len(conversation_tokens(df.filter("conv_id = 2"), 10**6).first().pieces)
    assert len(out[1].pieces) == 64


def test_batches_reach_their_size_and_models_are_called_with_lists(spark):
    df = spark.range(0, 45_000, 1, 1)
    sizes = sorted(r.n for r in batched_map(df, lambda x: pd.DataFrame({"n": [len(x)]}), "n long", batch_size=20_000).collect())
    assert sizes == [5_000, 20_000, 20_000]

    def factory():
        made = {"calls": 0}

        def model(prompts, **kw):
            made["calls"] += 1
            if "bad" in prompts:
                raise RuntimeError("no")
            return [f"{p}:{len(prompts)}:{made['calls']}" for p in prompts]
        return model

    prompts = spark.createDataFrame([("a",), ("b",), ("c",), ("bad",), ("d",)], "p string").coalesce(1)
    got = {r.p: (r.response, r.error) for r in infer(prompts, "p", factory, GenerationOptions(9), batch_size=3).collect()}
    assert got["a"] == ("a:3:1", None) and got["bad"] == (None, "RuntimeError: no") and got["d"][0].startswith("d:1:")


def test_every_file_counts(spark, tmp_path):
    for name, files in (("run 1", ["adapter_config.json", ".hidden", "_x", "empty"]), ("a+b%", []), ("only config", ["adapter_config.json"])):
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f).write_text("" if f == "empty" else '{"r": 4}')
    files = list_artifacts(spark, [str(tmp_path / "run 1"), str(tmp_path / "a+b%")])
    assert sorted((r.artifact, r.name or "") for r in files.collect()) == [
        ("a+b%", ""), ("run 1", ".hidden"), ("run 1", "_x"), ("run 1", "adapter_config.json"), ("run 1", "empty")]
    assert plain(list_artifacts(spark, str(tmp_path / "*")).filter("artifact <> 'only config'").collect()) == plain(files.collect())
    sizes = {r.artifact: (r.n_files, r.total_bytes) for r in inv.artifact_sizes(files).collect()}
    assert sizes == {"run 1": (4, 24), "a+b%": (0, 0)}
    report = {r.artifact: r for r in artifact_report(files, read_configs(spark, str(tmp_path / "*/adapter_config.json"))).collect()}
    assert set(report) == {"run 1", "a+b%", "only config"}
    assert report["run 1"].lora_r == "4" and report["only config"].n_files == 0 and not report["only config"].ready


def test_card_with_percent_and_publish_of_nothing(spark, tmp_path):
    row = spark.createDataFrame([("50% m", "1", "2", "q")], "base_model string, lora_r string, lora_alpha_text string, modules string")
    text = row.select(inv.card_text(license="100%s", tags=["%d"]).alias("c")).first().c
    assert "license: 100%s" in text and "- %d" in text and "base_model: 50% m" in text
    path = str(tmp_path / "t")
    publish(spark.range(3), path, "a:b/c")
    publish(spark.range(2), path)
    publish(spark.range(0), path, "a:b/c")
    assert {(r.revision, r["count"]) for r in spark.read.parquet(path).groupBy("revision").count().collect()} == {("main", 2)}
