"""Tokens, vocabularies, batches, shards, sampling and tables of artifacts."""

import json
import math
import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatweave.catalog import load
from chatweave.functions import tokens as tk
from chatweave.functions.text import one_decimal, thousands, two_decimals
from chatweave.operators import batching as b
from chatweave.operators import inventory as inv
from chatweave.operators import registry as reg
from chatweave.operators import sampling as s
from chatweave.operators import vocabulary
from chatweave.operators.inference import GenerationOptions, batched_map, infer
from chatweave.operators.ordered import byte_shards, enumerate_rows
from chatweave.operators.vocabulary import decode, encode, fit_vocabulary
from chatweave.plans.artifacts import artifact_report
from chatweave.plans.prepare import conversation_tokens, encoded_rows, prepare_from_files, run_prepare
from chatweave.plans.training import training_batches, write_batches, write_training_batches
from chatweave.schemas import DEVICE_INFO
from chatweave.sources.artifacts import list_artifacts, read_configs
from chatweave.sources.tables import write_sharded
from chatweave.sources.telemetry import host_memory, parse_device_csv, parse_memory_lines


@pytest.mark.parametrize("n,kept", [(0, 0), (1, 1), (1024, 1024), (1025, 1024), (2048, 1024), (3000, 1024)])
def test_truncations_fold(spark, n, kept):
    df = spark.createDataFrame([(list(range(n)),)], "ids array<int>")
    row = df.select(tk.truncate("ids", 2048, 1024).alias("t"), tk.attention_mask("ids").alias("m")).first()
    assert row["t"] == list(range(kept)) and row["m"] == [1] * n


def test_byte_ids(spark):
    texts = ["", "abc", "é€😀\n\x00", "".join(chr(i) for i in range(1, 300))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(tk.byte_ids("t")).collect()]
    assert got == [list(t.encode()) for t in texts]


def test_pad_default():
    assert tk.pad_id(None, 7) == 7 and tk.pad_id(0, 7) == 0


def test_new_tokens(spark):
    df = spark.createDataFrame([([1, 2, 3], 2), ([1, 2], 2), ([], 0)], "o array<int>, n int").coalesce(1)
    assert [r[0] for r in df.select(tk.new_tokens("o", "n")).collect()] == [[3], [], []]


@pytest.mark.parametrize("limit", [1000, 0])
def test_encode_and_decode(spark, limit):
    rows = [(1, ["a", "b", "a", "zz"]), (2, []), (3, None), (4, ["a"] * 3000)]
    df = spark.createDataFrame(rows, "k int, p array<string>").repartition(3)
    vocab = fit_vocabulary(df, "p", 2)
    assert [(r["piece"], r["id"], r["n"]) for r in vocab.orderBy("id").collect()] == [("a", 3, 3002), ("b", 4, 1)]
    coded = encode(df, "k", "p", vocab, "ids", limit=limit)
    got = {r["k"]: r["ids"] for r in coded.collect()}
    assert got == {1: [3, 4, 3, 0], 2: [], 3: None, 4: [3] * 3000}
    text = decode(coded.filter("k < 3"), "k", "ids", vocab, limit=limit)
    assert {r["k"]: r["text"] for r in text.collect()} == {1: "a b a", 2: ""}


def test_vocabulary_ties_follow_binary_order(spark):
    df = spark.createDataFrame([(["b", "B", "é", "a"],)], "p array<string>")
    assert [r["piece"] for r in fit_vocabulary(df, "p", 9).orderBy("id").collect()] == ["B", "a", "b", "é"]


def test_long_conversation_prefix(spark):
    rows = [(1, t, "user", "w " * (t % 5)) for t in range(500)] + [(2, 0, "user", "w " * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r["conv_id"]: r for r in conversation_tokens(df, max_length=100).collect()}

    def whole(conv):
        out = []
        for _, _, role, text in sorted(r for r in rows if r[0] == conv):
            out += ["<|", "im", "_", "start", "|>", role, *text.split(), "<|", "im", "_", "end", "|>"]
        return out

    for conv, n in ((1, 500), (2, 1)):
        assert got[conv]["n_messages"] == n
        assert got[conv]["n_tokens"] == len(whole(conv))
        assert got[conv]["pieces"] == whole(conv)[:100]


@pytest.mark.parametrize("n,ranks,batch,acc", [(100, 8, 4, 1), (3, 8, 4, 1), (64, 4, 4, 2), (1, 1, 1, 1), (37, 5, 3, 2)])
def test_batches(spark, n, ranks, batch, acc):
    layout = b.Layout(ranks, batch, acc)
    got = []
    for parts in (1, 4, 16):
        df = spark.range(n).withColumn("length", F.col("id") % 7).repartition(parts)
        plan = b.batch_plan(df, "id", "length", layout, seed=1, digits=1).collect()
        got.append(sorted(tuple(r) for r in plan))
    assert got[0] == got[1] == got[2]
    per_rank = [sum(r["rank"] == k for r in plan) for k in range(ranks)]
    assert set(per_rank) == {math.ceil(n / ranks)}
    assert {r["id"] for r in plan} == set(range(n))
    assert sorted(r["idx"] for r in plan) == list(range(ranks * per_rank[0]))
    assert max(r["step"] for r in plan) + 1 == math.ceil(per_rank[0] / (batch * acc))
    widths = {}
    for r in plan:
        widths.setdefault((r["rank"], r["step"], r["micro"]), []).append(r)
    for rows in widths.values():
        assert len(rows) <= batch and sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert {r["width"] for r in rows} == {max(r["length"] for r in rows)}


def test_without_wrap_ranks_may_be_short(spark):
    plan = b.batch_plan(spark.range(10).withColumn("n", F.lit(1)), "id", "n", b.Layout(4, 2), seed=3, wrap=False)
    counts = sorted(r["count"] for r in plan.groupBy("rank").count().collect())
    assert counts == [2, 2, 3, 3] and plan.count() == 10


def test_digits_follow_the_rows(spark):
    assert [b.order_digits(n) for n in (0, 800_000, 800_001, 10**8, 10**9, 10**12)] == [1, 1, 2, 3, 4, 4]
    got = {d: {r["id"]: r["idx"] for r in b.seeded_order(spark.range(500), "id", 1, digits=d).collect()} for d in (None, 1, 3)}
    assert got[None] == got[1] == got[3] and sorted(got[1].values()) == list(range(500))


def test_digits_are_bounded(spark):
    with pytest.raises(ValueError):
        b.seeded_order(spark.range(3), "id", 1, digits=5)


def test_padding_and_writing(spark, tmp_path):
    rows = [(i, list(range(i + 1))) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, ids array<int>")
    out = training_batches(df, "k", "ids", b.Layout(2, 3), pad=9, seed=5, max_length=6)
    for r in out.collect():
        ids, n = list(range(min(r["k"] + 1, 6))), r["width"]
        assert r["input_ids"] == ids + [9] * (n - len(ids))
        assert r["attention_mask"] == [1] * len(ids) + [0] * (n - len(ids))
        assert r["labels"] == ids + [-100] * (n - len(ids))
    write_batches(out, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.groupBy("rank").count().count() == 2
    write_training_batches(df, str(tmp_path / "c"), "k", "ids", b.Layout(2, 3), pad=9, seed=5, max_length=6)
    again = spark.read.parquet(str(tmp_path / "c"))
    assert again.columns == back.columns and not again.exceptAll(back).count() and not back.exceptAll(again).count()


@pytest.mark.parametrize("n", [912_577, 913_024])
def test_step_count(spark, n):
    assert spark.range(1).select(b.run_steps(F.lit(n), b.Layout(8, 56))).first()[0] == 2038


def test_checkpoint_schedule_and_retention(spark):
    sizes = spark.createDataFrame([("a", 913_024), ("b", 448 * 1000), ("c", 10)], "run string, n long")
    plan = b.checkpoint_schedule(sizes, "n", b.Layout(8, 56))
    got = {}
    for r in plan.collect():
        got.setdefault(r["run"], []).append(r["step"])
    assert {k: sorted(v) for k, v in got.items()} == {"a": [1000, 2000, 2038], "b": [1000], "c": [1]}
    many = spark.createDataFrame([("a", st) for st in range(1, 9)], "run string, step int")
    assert sorted(r["step"] for r in b.keep_newest(many, "run", "step").collect()) == [6, 7, 8]
    resumed = b.resume_point(plan, "run", "step").collect()
    assert {r["run"]: r["resume_step"] for r in resumed} == {"a": 1000, "b": 1000, "c": None}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_shards_and_numbers(spark, partitions):
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, n long").repartition(partitions)
    got = {r["k"]: (r["bytes_before"], r["shard"]) for r in byte_shards(df, "k", "n", 200, partitions=partitions).collect()}
    before = 0
    for k, n in rows:
        assert got[k] == (before, before // 200)
        before += n
    numbered = enumerate_rows(df.select("k"), ["k"], partitions=partitions).collect()
    assert all(r["n"] == r["k"] + 1 for r in numbered)
    with pytest.raises(ValueError):
        byte_shards(df, "k", "n", 10, max_row_bytes=10)


def test_sharded_sink_stays_below_the_cap(spark, tmp_path):
    df = spark.createDataFrame([(i, "é" * (i % 20)) for i in range(200)], "k int, t string").repartition(3)
    write_sharded(df, str(tmp_path / "s"), "k", "t", cap=100, max_row_bytes=38)
    sizes = spark.read.parquet(str(tmp_path / "s")).groupBy("shard").agg(F.sum(F.octet_length("t")).alias("n"), F.count("k").alias("c"))
    got = sizes.collect()
    assert max(r["n"] for r in got) <= 100 and sum(r["c"] for r in got) == 200


def brute_nucleus(scores, temperature, k, p):
    order = sorted(scores, key=lambda c: (-scores[c], c))[:k]
    w = [math.exp((scores[c] - scores[order[0]]) / temperature) for c in order]
    kept, before = [], 0.0
    for c, x in zip(order, w):
        if before < p or not kept:
            kept.append(c)
        before += x / sum(w)
    return kept


@pytest.mark.parametrize("k", [5, None, 40])
def test_nucleus(spark, k, monkeypatch):
    monkeypatch.setattr(s, "GROUP_LIMIT", 20)
    rng = random.Random(4)
    groups = {g: {c: rng.choice([0.0, 1.0, rng.random() * 6]) for c in range(30)} for g in range(20)}
    groups[99] = {c: rng.random() for c in range(600)}
    groups[98] = {0: 50.0, 1: 1.0}
    rows = [(g, c, x) for g, sc in groups.items() for c, x in sc.items()]
    df = spark.createDataFrame(rows, "group_id long, cand int, score double").repartition(5)
    got = {}
    for r in s.nucleus(df, 0.7, k, 0.9).collect():
        got.setdefault(r["group_id"], []).append(r["cand"])
    for g, sc in groups.items():
        assert sorted(got[g]) == sorted(brute_nucleus(sc, 0.7, k, 0.9))
    assert got[98] == [0]


def test_greedy_ties_and_cold_draw(spark):
    df = spark.createDataFrame([(1, 3, 1.0), (1, 2, 1.0), (1, 5, 0.5)], "group_id long, cand int, score double")
    assert s.greedy(df).first()["cand"] == 2
    assert s.weighted_pick(df, 1, temperature=0).first()["cand"] == 2


def test_draws_follow_the_weights(spark):
    df = spark.range(4000).select(
        F.col("id").alias("group_id"), F.explode(F.array(F.struct(F.lit(0).alias("cand"), F.lit(math.log(3.0)).alias("score")),
                                                         F.struct(F.lit(1).alias("cand"), F.lit(0.0).alias("score")))).alias("x"),
    ).select("group_id", "x.*")
    share = s.weighted_pick(df, 11, temperature=1.0, k=2, p=1.0).agg(F.avg((F.col("cand") == 0).cast("int"))).first()[0]
    assert abs(share - 0.75) < 0.03
    again = [s.weighted_pick(df.repartition(n), 11, 1.0, 2, 1.0).agg(F.sum(F.xxhash64("group_id", "cand") % 1000)).first()[0] for n in (1, 7)]
    assert again[0] == again[1]


@pytest.mark.parametrize("default,model", [("32b", "32B"), ("14b", "14B")])
def test_unknown_model(spark, default, model):
    df = spark.createDataFrame([("72b",), (None,)], "size string")
    rows = reg.lookup_model(df, "size", reg.registry_table(spark), default).collect()
    assert all(model in r["model"] for r in rows) and len(rows) == 2
    with pytest.raises(KeyError):
        reg.lookup_model(df, "size", reg.registry_table(spark), "none")


def test_missing_files(spark):
    rows = [("a", None), ("b", "adapter_model.safetensors"), ("b", "x"), ("c", "adapter_config.json"), ("c", "adapter_model.safetensors")]
    got = inv.missing_files(spark.createDataFrame(rows, "artifact string, name string")).collect()
    assert {r["artifact"]: r["missing"] for r in got} == {
        "a": ["adapter_config.json", "adapter_model.safetensors"], "b": ["adapter_config.json"], "c": []
    }


def test_artifact_folders(spark, tmp_path):
    for name, config in (("a1", {"r": 8, "target_modules": ["q", "v"]}), ("a2", {"base_model_name_or_path": "m"})):
        (tmp_path / name / "sub").mkdir(parents=True)
        (tmp_path / name / "adapter_config.json").write_text(json.dumps(config, indent=1))
        (tmp_path / name / "w.bin").write_bytes(b"x" * 2048)
        (tmp_path / name / "sub" / "deep.bin").write_bytes(b"y")
    files = list_artifacts(spark, str(tmp_path / "*"))
    assert sorted(r["name"] for r in files.filter("artifact = 'a1'").collect()) == ["adapter_config.json", "w.bin"]
    sizes = {r["artifact"]: r["n_files"] for r in inv.artifact_sizes(files).collect()}
    assert sizes == {"a1": 2, "a2": 2}
    rows = {r["artifact"]: r for r in inv.config_defaults(read_configs(spark, str(tmp_path / "*/adapter_config.json"))).withColumn(
        "card", inv.card_text()).collect()}
    assert (rows["a1"]["base_model"], rows["a1"]["lora_r"], rows["a1"]["modules"]) == ("unknown", "8", "q, v")
    assert (rows["a2"]["base_model"], rows["a2"]["lora_r"], rows["a2"]["modules"]) == ("m", "unknown", "")
    assert "| Rank (r) | 8 |" in rows["a1"]["card"]


def test_artifact_report(spark, tmp_path):
    for name, files in (("a1", ["adapter_model.safetensors"]), ("a2", [])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "adapter_config.json").write_text('{"r": 4}')
        for f in files:
            (tmp_path / name / f).write_bytes(b"x" * 100)
    files = list_artifacts(spark, str(tmp_path / "*"))
    configs = read_configs(spark, str(tmp_path / "*/adapter_config.json"))
    rows = {r["artifact"]: r for r in artifact_report(files, configs).collect()}
    assert rows["a1"]["ready"] and rows["a1"]["n_files"] == 2 and rows["a1"]["total_bytes"] == 108
    assert not rows["a2"]["ready"] and rows["a2"]["missing"] == ["adapter_model.safetensors"]
    assert "| Rank (r) | 4 |" in rows["a1"]["card"]


def test_config_wins_over_given_base(spark):
    adapters = spark.createDataFrame([("a", "m1"), ("b", None)], "artifact string, base_model_name_or_path string")
    bases = spark.createDataFrame([("m1", 1), ("m2", 2)], "base_model string, size int")
    got = {r["artifact"]: r["size"] for r in reg.pair_adapters(adapters, bases, given="m2").collect()}
    assert got == {"a": 1, "b": 2}


def test_telemetry(spark):
    lines = ["[Rank 0] [MEM:START] GPU0: 10MB / 100MB", "[Rank 3] [MEM:START] RAM: 1,024MB / 2,048MB (50.0%)",
             "[Rank 0] [MEM:START] Error: x", "noise"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
    assert [tuple(r) for r in parse_memory_lines(df).collect()] == [(0, "START", "GPU0", 10, 100), (3, "START", "RAM", 1024, 2048)]
    csv = spark.createDataFrame([("0, 10, 100",), ("0, 10",), ("1,2,3",)], "line string")
    assert [tuple(r) for r in parse_device_csv(csv).collect()] == [(0, 10, 100)]
    mem = [("h", 0, "MemTotal:  2097152 kB"), ("h", 1, "MemAvailable: 1049599 kB"), ("h", 2, "MemTotal: 1 kB")]
    row = host_memory(spark.createDataFrame(mem, "host string, line_no int, line string")).first()
    assert (row["total_mb"], row["used_mb"]) == (2048, 2048 - 1049599 // 1024)


def test_devices_and_displays(spark):
    df = spark.createDataFrame([(True, 2, [(0, "g", 80.0), (1, "g", 40.5)]), (False, 0, [])], DEVICE_INFO).coalesce(1)
    assert [r[0] for r in df.select(inv.device_memory()).collect()] == [120.5, 0.0]
    row = spark.range(1).select(one_decimal(F.lit(2.34)), two_decimals(F.lit(2.345678)), thousands(F.lit(1234567))).first()
    assert tuple(row) == ("2.3", "2.35", "1,234,567")


def test_inference_catches_failures(spark):
    def factory():
        def model(prompt, **kw):
            if prompt == "bad":
                raise RuntimeError("no")
            return f"{prompt}:{kw['max_new_tokens']}:{'top_k' in kw}"
        return model

    df = spark.createDataFrame([("ok",), ("bad",)], "p string")
    got = {r["p"]: (r["response"], r["error"]) for r in infer(df, "p", factory, GenerationOptions(9, temperature=0)).collect()}
    assert got == {"ok": ("ok:9:False", None), "bad": (None, "RuntimeError: no")}


def test_batched_map_batches(spark):
    df = spark.range(0, 100, 1, 2)
    sizes = batched_map(df, lambda x: x.assign(n=len(x))[["n"]], "n long", batch_size=20)
    assert {r["n"] for r in sizes.collect()} <= {20, 10} and sizes.count() == 100


def test_prepare_job(spark, tmp_path):
    pairs = spark.createDataFrame([(i, f"q{i} x", f"a{i}") for i in range(20)], "row_ord long, input string, output string")
    chats = spark.createDataFrame([(i, "s", f"c{i}") for i in range(5)], "row_ord long, system string, chat string")
    from chatweave.plans.prepare import prepare_dataset

    text = prepare_dataset(pairs, chats, 15, 200)
    assert text.count() == 20
    for name, df in (("p", pairs), ("c", chats)):
        df.drop("row_ord").coalesce(1).write.parquet(str(tmp_path / name))
    same = prepare_from_files(spark, str(tmp_path / "p"), str(tmp_path / "c"), 15, 200)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, text.collect()))
    vocab = fit_vocabulary(text.select(tk.pieces("text").alias("p")), "p", 100)
    report = run_prepare(spark, pairs, chats, vocab, str(tmp_path / "d"), pair_rows=15, chat_rows=200)
    assert report.rows == 20 and report.seconds > 0 and report.rows_per_second > 0
    rows = spark.read.parquet(str(tmp_path / "d")).collect()
    assert all(len(r["input_ids"]) == len(r["attention_mask"]) > 0 and r["text"] for r in rows)
    short = encoded_rows(text.select("key", "text"), vocab, "key", max_length=4).select(F.max(F.size("input_ids"))).first()[0]
    assert short == 4


def test_parts_of_a_file_are_one_file(spark, tmp_path):
    write = "0aab3c1d-1111-2222-3333-0123456789ab"
    rows = [("a", f"part-0000{i}-{write}{c}.txt", 10 + i) for i in range(3) for c in (".c000", ".c001")]
    rows += [("a", "part-x.txt", 5), ("b", f"part-00000-{write}.c000.txt", 1), ("c", None, None)]
    rows += [("b", f"part-00000-{write}.c000.snappy.parquet", 2)]
    got = inv.whole_files(spark.createDataFrame(rows, "artifact string, name string, length bigint")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", f"part-{write}.txt", 66), ("a", "part-x.txt", 5), ("b", f"part-{write}.txt", 1),
        ("b", f"part-{write}.snappy.parquet", 2), ("c", None, None)], key=str)


def test_texts_of_a_language_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id AS doc_id", "'xx' AS lang", "repeat('text ', 20) AS text")
    rows.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("artifacts-*"))
    got = load()[0]["artifact_scan"](spark, str(tmp_path)).collect()
    assert [tuple(r)[:4] for r in got] == [("lang=xx", 1, "text", 4000 * 101)]
    (made,) = set(shared.glob("artifacts-*")) - before
    assert len(list(made.glob("lang=xx/part-*"))) > 1


def test_lookups_take_slices_of_a_batch():
    rows = [["a"] * 150_000, None, [], ["b", None], ["a"] * 450_000, ["x"], *([["b"] * 1000] * 500)]
    column = pa.array(rows, pa.list_(pa.string()))
    parts = list(vocabulary._slices(iter([column, column.slice(0, 0), column.slice(1, 3)])))
    assert [x for p in parts for x in p.to_pylist()] == rows + rows[1:4]
    assert all(len(p) <= 1 or len(p.flatten()) <= vocabulary.SLICE for p in parts)
    look = vocabulary._flat_lookup({"a": 3, "b": 4}, 0, pa.int32())
    got = [x for p in parts for x in look(p).to_pylist()]
    assert got == [r and [{"a": 3, "b": 4}.get(x, 0) for x in r] for r in rows + rows[1:4]]
