"""Edge rows of sources, canonical rows and templates."""

import pytest
from pyspark.sql import functions as F

from chatweave.functions.messages import prompt_messages, render
from chatweave.functions.text import base_name, join_list, preview, strip
from chatweave.operators.canonical import canonical_chats, canonical_pairs, mix_sources, nest_messages
from chatweave.operators.ordered import head_slice
from chatweave.schemas import MESSAGES
from chatweave.sources.prompts import prompt_table
from chatweave.sources.tables import (
    fingerprint,
    materialise,
    path_exists,
    publish,
    read_in_storage_order,
    read_jsonl,
    require_path,
    write_jsonl,
)


def messages(df):
    return [[(m["role"], m["content"]) for m in r["messages"]] for r in df.collect()]


def test_existing_column_keeps_its_null(spark):
    df = spark.createDataFrame([(None, "x", "y")], "input string, instruction string, output string")
    assert messages(canonical_pairs(df)) == [[("user", None), ("assistant", "y")]]
    assert messages(canonical_pairs(df, null_fallback=True)) == [[("user", "x"), ("assistant", "y")]]


def test_second_name_and_missing_columns(spark):
    df = spark.createDataFrame([("q", "a")], "instruction string, response string")
    assert messages(canonical_pairs(df)) == [[("user", "q"), ("assistant", "a")]]
    bare = spark.createDataFrame([(1,)], "other int")
    assert messages(canonical_pairs(bare)) == [[("user", ""), ("assistant", "")]]


def test_system_only_if_not_empty(spark):
    df = spark.createDataFrame([(None, "c"), ("", "c"), (" ", "c")], "system string, chat string").coalesce(1)
    assert messages(canonical_chats(df)) == [
        [("user", "c")], [("user", "c")], [("system", " "), ("user", "c")]
    ]


def test_string_chat_is_not_parsed(spark):
    df = spark.createDataFrame([("s", "USER: a ASSISTANT: b")], "system string, chat string")
    assert messages(canonical_chats(df)) == [[("system", "s"), ("user", "USER: a ASSISTANT: b")]]


def test_list_chat(spark):
    df = spark.createDataFrame(
        [("s", []), (None, []), (None, [("user", "u"), ("assistant", "a")])], f"system string, chat {MESSAGES}"
    ).coalesce(1)
    assert messages(canonical_chats(df)) == [[("system", "s")], [], [("user", "u"), ("assistant", "a")]]


def test_missing_chat_column_and_wrong_type(spark):
    df = spark.createDataFrame([("s",)], "system string")
    assert messages(canonical_chats(df)) == [[("system", "s"), ("user", "")]]
    with pytest.raises(TypeError):
        canonical_chats(spark.createDataFrame([(1,)], "chat int"))


def test_null_chat(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, chat string")
    with pytest.raises(Exception, match="chat is null"):
        canonical_chats(df).collect()
    assert canonical_chats(df, keep=("k",), on_null="drop").count() == 1
    flagged = {r["k"]: r for r in canonical_chats(df, keep=("k",), on_null="flag").collect()}
    assert flagged[1]["error"] == "chat is null" and flagged[1]["messages"] is None
    assert flagged[2]["error"] is None


def test_mix_keeps_order_and_duplicates(spark):
    a = spark.createDataFrame([(0, "x"), (1, "x")], "row_ord int, v string")
    b = spark.createDataFrame([(0, "x")], "row_ord int, v string")
    rows = mix_sources(a, b).orderBy("src_ord", "row_ord").collect()
    assert [(r["src_ord"], r["row_ord"]) for r in rows] == [(0, 0), (0, 1), (1, 0)]


def test_templates(spark):
    df = spark.createDataFrame([("hi", "s"), ("hi", "")], "p string, s string").coalesce(1)
    out = df.select(
        render(prompt_messages("p", F.col("s"))).alias("a"),
        render(prompt_messages("p", F.col("s")), default_system="d", generation_prompt=True).alias("b"),
    ).collect()
    user = "<|im_start|>user\nhi<|im_end|>\n"
    assert out[0]["a"] == "<|im_start|>system\ns<|im_end|>\n" + user
    assert out[1]["a"] == user
    assert out[0]["b"] == out[0]["a"] + "<|im_start|>assistant\n"
    assert out[1]["b"] == "<|im_start|>system\nd<|im_end|>\n" + user + "<|im_start|>assistant\n"


@pytest.mark.parametrize("blank", ["\t\n", " ", "\x1c", "　 \x85", "\x1f "])
def test_strip(spark, blank):
    df = spark.createDataFrame([(blank,), (blank + "a b" + blank,), ("a\n",)], "t string").coalesce(1)
    assert [r[0] for r in df.select(strip("t")).collect()] == ["", "a b", "a"]


def test_strip_agrees_with_python(spark):
    texts = [(i, chr(i) + "x" + chr(i)) for i in list(range(0x300)) + list(range(0x1600, 0x3100))]
    df = spark.createDataFrame(texts, "i int, t string").withColumn("s", strip("t"))
    assert [r["i"] for r in df.collect() if r["s"] != r["t"].strip()] == []


def test_short_displays(spark):
    df = spark.createDataFrame([("short", "a/b/c", None), ("x" * 60, "c", ["a", "b"])],
                               "t string, p string, m array<string>").coalesce(1)
    rows = df.select(preview("t"), base_name("p"), join_list("m")).collect()
    assert [tuple(r) for r in rows] == [("short...", "c", ""), ("x" * 50 + "...", "c", "a, b")]


@pytest.mark.parametrize("n,in_one_task", [(5, 100), (5, 0), (50, 100), (50, 0), (20, 0)])
@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_head_slice(spark, n, in_one_task, partitions):
    rows = [(i % 3, i // 3, f"v{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "a int, b int, v string").repartition(partitions)
    got = sorted(tuple(r) for r in head_slice(df, ["a", "b"], n, in_one_task).collect())
    assert got == sorted(rows)[:n]


@pytest.mark.parametrize("n", [0, 1, 12, 25, 26, 99, None])
def test_storage_order(spark, tmp_path, n):
    path = str(tmp_path / "s")
    for low in range(0, 40, 10):
        # Names in order: each append sorts behind the earlier ones only by its prefix.
        spark.range(low, low + 10).coalesce(1).write.parquet(f"{path}/part={low:02d}")
    rows = read_in_storage_order(spark, f"{path}/*", n).collect()
    want = 40 if n is None else min(n, 40)
    assert sorted((r["row_ord"], r["id"]) for r in rows) == [(i, i) for i in range(want)]


def test_nest_in_parts(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    parts = nest_messages(df, part_size=4).orderBy("part").collect()
    assert [[m["content"] for m in p["messages"]] for p in parts] == [
        ["m0", "m1", "m2", "m3"], ["m4", "m5", "m6", "m7"], ["m8", "m9"]
    ]


def test_jsonl_keeps_nulls_and_order(spark, tmp_path):
    rows = [(i, [("user", None if i == 3 else f"é{i}")]) for i in range(20)]
    df = spark.createDataFrame(rows, f"k int, messages {MESSAGES}").repartition(5)
    path = str(tmp_path / "j")
    write_jsonl(df, path, order=["k"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part-*"))).splitlines()
    assert lines[3] == '{"messages":[{"role":"user","content":null}]}'
    assert len(lines) == 20 and "é7" in lines[7]
    back = sorted(m[0][1] or "" for m in messages(read_jsonl(spark, path)))
    assert back == sorted(("" if i == 3 else f"é{i}") for i in range(20))


def test_broken_line_stops_the_job(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"messages": [}\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path)).collect()


def test_materialise(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "m")
    for _ in range(2):
        assert materialise(spark, path, {"size": "14b"}, build).count() == 3
    assert len(calls) == 1
    materialise(spark, path, {"size": "32b"}, build)
    assert len(calls) == 2
    # A folder without its success mark is partial and is built again.
    (tmp_path / "m" / fingerprint({"size": "14b"}) / "_SUCCESS").unlink()
    materialise(spark, path, {"size": "14b"}, build)
    assert len(calls) == 3


def test_publish_replaces_one_revision(spark, tmp_path):
    path = str(tmp_path / "p")
    publish(spark.range(3), path)
    publish(spark.range(5), path, "v1")
    publish(spark.range(4), path)
    counts = {r["revision"]: r["count"] for r in spark.read.parquet(path).groupBy("revision").count().collect()}
    assert counts == {"main": 4, "v1": 5}


def test_paths(spark, tmp_path):
    assert not path_exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        require_path(spark, str(tmp_path / "none"))


def test_prompt_table(spark):
    rows = prompt_table(spark, ["a", ("n", "b"), {"prompt": "c", "system": "s", "max_new_tokens": 9}]).collect()
    assert [(r["idx"], r["name"], r["system"], r["prompt"], r["max_new_tokens"]) for r in rows] == [
        (1, None, None, "a", 512), (2, "n", None, "b", 512), (3, None, "s", "c", 9)
    ]
