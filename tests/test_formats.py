"""Line files, published revisions, templates, mixed chats, shards and job reports."""

import json
import os
import threading
from datetime import timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chatweave.functions.templates import CHATML, HEADERS, INST, TEMPLATES, ChatTemplate, compile_template
from chatweave.operators.canonical import canonical_chats
from chatweave.operators.lengths import length_sketches, length_stats, merge_sketches
from chatweave.plans.progress import remaining_seconds, stream_progress, write_all
from chatweave.schemas import CHAT_ROWS
from chatweave.sources import published, tables
from chatweave.sources.published import CommitConflict, commit, history, newest, publish_commit, read_published, stage
from chatweave.sources.tables import place_shards, write_sharded
from chatweave.sources.telemetry import BROKEN, read_device_lines, read_lines
from chatweave.streaming.run import run_to_end


def test_line_files_have_the_time_of_their_file(spark, tmp_path):
    for name, when, text in (("a.log", 1_700_000_000, "one\n\ntwo"), ("sub/b.log", 1_700_086_400, "three\n"), ("c.txt", 1, "no\n")):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        os.utime(path, (when, when))
    rows = read_lines(spark, str(tmp_path / "in"), names="*.log").collect()
    got = sorted((r.ingest_ts.replace(tzinfo=timezone.utc) if r.ingest_ts.tzinfo is None else r.ingest_ts, r.file.rsplit("/", 1)[1], r.line) for r in rows)
    assert [g[1:] for g in got] == [("a.log", ""), ("a.log", "one"), ("a.log", "two"), ("b.log", "three")]
    days = read_lines(spark, str(tmp_path / "in"), names="*.log").select(F.unix_timestamp("ingest_ts").alias("s")).distinct().collect()
    assert {r.s for r in days} == {1_700_000_000, 1_700_086_400}

    def go():
        stream = read_lines(spark, str(tmp_path / "in"), stream=True, files_per_batch=1, names="*.log")
        return {r.line for r in run_to_end(spark, stream, str(tmp_path / "out"), str(tmp_path / "state")).collect()}

    assert go() == {"", "one", "two", "three"}
    (tmp_path / "in" / "d.log").write_text("four\n")
    assert go() == {"", "one", "two", "three", "four"}


def test_device_lines(spark):
    lines = ["0, 10, 100", "1,20,200", " 2 ,  30, 300 ", "3, 40", "4, 50, 500, 6", "5, x, 100", "", "  ", "words", "6, 1.5, 7", '7, "80", 800', ",,"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")
    got = {r.n: (r.device, r.used_mb, r.total_mb, r[BROKEN]) for r in read_device_lines(df).collect()}
    assert got[0] == (0, 10, 100, None) and got[1] == (1, 20, 200, None) and got[2] == (2, 30, 300, None) and got[10] == (7, 80, 800, None)
    assert got[11] == (None, None, None, None)
    for n in (3, 4, 5, 8, 9):
        assert got[n] == (None, None, None, lines[n])
    assert 6 not in got and 7 not in got


def test_readers_see_whole_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert history(spark, path).count() == 0 and newest(spark, path) is None
    assert publish_commit(spark.range(10), path, message="ten") == 0
    reading = read_published(spark, path)
    # Staged and not committed: a writer that dies here has changed nothing.
    waiting = stage(spark.range(5).selectExpr("id", "'x' AS more"), path)
    assert read_published(spark, path).count() == 10 and newest(spark, path) == 0
    assert commit(spark, path, waiting, message="five", parent=0) == 1
    assert reading.count() == 10  # a reader that began before goes on with what it saw
    assert read_published(spark, path).columns == ["id", "more"] and read_published(spark, path).count() == 5
    assert read_published(spark, path, number=0).columns == ["id"]
    with pytest.raises(CommitConflict):
        commit(spark, path, waiting, parent=0)
    assert publish_commit(spark.range(0), path) == 2 and read_published(spark, path).count() == 0
    assert publish_commit(spark.range(1), path, "a/b .. c", "other") == 0
    told = {(r.revision, r.number): r for r in history(spark, path).collect()}
    assert {k: (r.parent, r.message, r.n_rows) for k, r in told.items()} == {
        ("main", 0): (None, "ten", 10), ("main", 1): (0, "five", 5), ("main", 2): (1, "", 0), ("a/b .. c", 0): (None, "other", 1)}
    files = spark.read.parquet(f"{path}/files/{told['main', 0].folder.split('/')[1]}")
    assert files.agg(F.sum("n_rows")).first()[0] == 10 and told["main", 0].bytes > 0


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path, numbers = str(tmp_path / "t"), []
    ready = threading.Barrier(4)

    def write(n):
        staged = stage(spark.range(n), path)
        ready.wait()
        while True:
            try:
                numbers.append((commit(spark, path, staged, message=str(n), parent=newest(spark, path)), n))
                return
            except CommitConflict:
                continue

    threads = [threading.Thread(target=write, args=(n,)) for n in (1, 2, 3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert sorted(x for x, _ in numbers) == [0, 1, 2, 3]
    for number, n in numbers:
        assert read_published(spark, path, number=number).count() == n
    assert history(spark, path).filter("number > 0 AND parent <> number - 1").count() == 0
    assert published.folder_name("..") != ".." and "/" not in published.folder_name("a/b")


CHAT = [("system", " S "), ("user", " hi\n"), ("assistant", None), ("user", "x")]


def written(spark, template, chat, answer=False):
    df = spark.createDataFrame([([{"role": r, "content": c} for r, c in chat] if chat is not None else None,)], CHAT_ROWS)
    return df.select(compile_template(template, "messages", answer).alias("t")).first()["t"]


def test_templates(spark):
    assert written(spark, CHATML, CHAT, True) == (
        "<|im_start|>system\n S <|im_end|>\n<|im_start|>user\n hi\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
        "<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\n")
    assert written(spark, HEADERS, CHAT[:2]) == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>")
    assert written(spark, INST, CHAT) == "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nhi [/INST]  </s><s>[INST] x [/INST]"
    assert written(spark, INST, CHAT[1:2]) == "<s>[INST] hi [/INST]"
    given = {**json.loads(CHATML.to_json()), "default_system": "D"}
    default = ChatTemplate.from_json(json.dumps(given))
    assert written(spark, default, CHAT[3:]) == "<|im_start|>system\nD<|im_end|>\n<|im_start|>user\nx<|im_end|>\n"
    assert written(spark, default, CHAT[:1]) == "<|im_start|>system\n S <|im_end|>\n"
    dropped = ChatTemplate("plain", {"user": ("U:", "\n"), "assistant": ("A:", "\n")}, system="drop")
    assert written(spark, dropped, CHAT) == "U: hi\n\nA:\nU:x\n" and written(spark, dropped, []) == ""
    assert written(spark, CHATML, None) is None
    for chat in ([("tool", "x")], [(None, "x")], [("user", "x"), ("system", "late")]):
        with pytest.raises(PySparkException, match="no marks for role"):
            written(spark, INST, chat)
    assert {name: ChatTemplate.from_json(t.to_json()) for name, t in TEMPLATES.items()} == TEMPLATES


@pytest.mark.parametrize("change", [
    {"system": "middle"}, {"turns": {"user": ["a", "b"]}}, {"turns": {"user": ["a", "b"], "assistant": ["a", "b"]}},
    {"colour": 1}, {"turns": {"user": ["a"], "assistant": ["a", "b"], "system": ["a", "b"]}}])
def test_bad_templates(change):
    with pytest.raises(ValueError):
        ChatTemplate.from_json(json.dumps({**json.loads(CHATML.to_json()), **change}))


def test_mixed_chats(spark, tmp_path):
    lines = [
        '{"n": 0, "system": "S", "chat": "a string"}', '{"n": 1, "chat": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}',
        '{"n": 2, "chat": []}', '{"n": 3, "chat": null}', '{"n": 4}', '{"n": 5, "chat": 7}', '{"n": 6, "chat": {"role": "user", "content": "q"}}',
        '{"n": 7, "chat": [{"role": "user", "content": "q"}, "loose"]}', '{"n": 8, "chat": [{"content": "q"}]}',
        '{"n": 9, "chat": [{"role": "user", "content": null, "extra": [1]}]}', '{"n": 10, "chat": [{"role": "user", "content": 12}]}']
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    df = spark.read.schema("n int, system string, chat variant").json(str(tmp_path / "in.json"))
    rows = {r.n: r for r in canonical_chats(df, keep=("n",), on_null="flag").collect()}
    got = {n: [tuple(m) for m in r.messages] for n, r in rows.items() if r.messages is not None}
    assert got == {0: [("system", "S"), ("user", "a string")], 1: [("user", "q"), ("assistant", "a")], 2: [],
                   9: [("user", None)], 10: [("user", "12")]}
    assert {n: r.error for n, r in rows.items() if r.error} == {
        3: "chat is null", 4: "chat is null", 5: "chat is BIGINT", 6: "chat is OBJECT<content: STRING, role: STRING>",
        7: "chat has an element that is no message", 8: "chat has a message without a role"}
    assert canonical_chats(df, keep=("n",), on_null="drop").count() == 5
    with pytest.raises(PySparkException, match="chat is "):
        canonical_chats(df, keep=("n",)).collect()


@pytest.mark.parametrize("limit", [10_000, 3])
def test_shards_by_first_keys(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(tables, "PLACED_SHARDS", limit)
    rows = [(i // 2 if i < 40 else i, "x" * (10 + i % 7)) for i in range(300)] + [(None, "none")]
    df = spark.createDataFrame(rows, "k bigint, t string").repartition(5)
    write_sharded(df, str(tmp_path / "s"), "k", "t", cap=100, max_row_bytes=17)
    back = spark.read.parquet(str(tmp_path / "s")).withColumn("_f", F.col("_metadata.file_path"))
    found = back.groupBy("shard").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.sum(F.length("t")).alias("n"), F.count("k").alias("c"),
                                      F.countDistinct("_f").alias("files")).orderBy("shard").collect()
    assert back.count() == 301 and len(found) > 30
    assert all(x.b < y.a for x, y in zip(found, found[1:])) and all(r.files == 1 for r in found)
    assert all(r.n <= 100 + 40 for r in found)


def test_shards_take_one_wide_exchange(spark):
    df = spark.range(5000).selectExpr("id AS k", "repeat('x', 50) AS t")
    plan = place_shards(df, "k", "t", cap=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert place_shards(df, "k", "t", cap=1000).rdd.getNumPartitions() == 250
    empty = place_shards(df.limit(0), "k", "t", cap=1000)
    assert empty.count() == 0 and empty.columns == ["k", "t", "shard"]


def test_reports_of_jobs(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' END AS s")
    told = write_all(spark, {"x": (df, str(tmp_path / "x")), "y": (df.limit(0), str(tmp_path / "y"))}, "s", ("a", "b", "c")).collect()
    assert {(r.sink, r.source): r.n_rows for r in told} == {
        ("x", None): 30, ("x", "a"): 10, ("x", "b"): 10, ("x", "c"): 0, **{("y", s): 0 for s in (None, "a", "b", "c")}}
    assert all(r.seconds > 0 and r.rows_per_second == r.n_rows / r.seconds for r in told)
    spark.range(40).repartition(4).write.parquet(str(tmp_path / "in"))
    q = (spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).writeStream.queryName("copy")
         .format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    q.awaitTermination()
    batches = stream_progress(spark, q)
    rows = batches.filter("n_rows > 0").collect()
    assert len(rows) == 4 and sum(r.n_rows for r in rows) == 40 and all(r.name == "copy" and r.rows_per_second > 0 for r in rows)
    left = remaining_seconds(160, batches).first()
    assert (left.n_rows, left.left, left.percent) == (40, 120, 25) and left.seconds_left > 0


def test_length_statistics(spark):
    rows = [("a", ["x"] * i + ["y"]) for i in range(200)] + [("b", []), ("b", ["z", "z", "w"])]
    df = spark.createDataFrame([(g, str(len(p) % 3), p) for g, p in rows], "g string, part string, p array<string>")
    got = {r.g: tuple(r)[1:] for r in length_stats(df, "g", "p").collect()}
    assert got == {"a": (200, 20100, 200, 100.5, 180.1, 2), "b": (2, 3, 3, 1.5, 2.7, 2)}
    merged = {r.g: r for r in merge_sketches(length_sketches(df, ["g", "part"], "p"), "g").collect()}
    assert merged["a"].n_docs == 200 and merged["a"].n_tokens == 20100 and merged["a"].longest == 200 and merged["a"].n_distinct == 2
    assert abs(merged["a"].p50 - 100) <= 4 and abs(merged["a"].p90 - 180) <= 4 and merged["b"].n_distinct == 2
