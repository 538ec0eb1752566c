"""Session replay against a direct simulation, in batch and on streams."""

import random

import pytest
from pyspark.sql import functions as F

from chatweave.functions.text import classify_command, command_argument, strip
from chatweave.operators.sessions import DEFAULT_SYSTEM, session_state, turn_context
from chatweave.schemas import SESSION_INPUT
from chatweave.streaming import readers
from chatweave.streaming.state import chat_contexts, responses


def simulate(rows, default=DEFAULT_SYSTEM):
    """What a session sends for each input, one input after the other."""
    out, state = {}, {}
    for conv, turn, text, reply in sorted(rows, key=lambda r: r[:2]):
        s = state.setdefault(conv, {"h": [], "sys": default, "open": True})
        t = text.strip()
        if not s["open"] or not t:
            continue
        low = t.lower()
        if low in ("/exit", "/quit"):
            s["open"] = False
        elif low == "/clear":
            s["h"] = []
        elif low.startswith("/system "):
            s["sys"], s["h"] = t[8:].strip(), []
        else:
            head = [("system", s["sys"])] if s["sys"] else []
            out[conv, turn] = [*head, *s["h"], ("user", t)]
            if reply is not None:
                s["h"] = [*s["h"], ("user", t), ("assistant", reply)][-20:]
    return out


def random_sessions(n, longest, seed, conv0=0, failing=0.15):
    rng = random.Random(seed)
    odd = [" /CLEAR ", "/system  Be Brief ", "/system", "/quit now", "\t ", "/clear", "/System X"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            r = rng.random()
            text = rng.choice(odd) if r < 0.06 else "/exit" if r > 0.997 else f" u{c}-{t}\n"
            rows.append((conv0 + c, t, text, None if rng.random() < failing else f"r{t}"))
    return rows


def contexts(df):
    return {
        (r["conv_id"], r["turn"]): [(m["role"], m["content"]) for m in r["messages"]] for r in df.collect()
    }


@pytest.mark.parametrize("span", [4096, 64, 7])
@pytest.mark.parametrize("partitions", [1, 16])
def test_contexts_equal_simulation(spark, span, partitions):
    rows = random_sessions(40, 60, seed=span)
    # One session with a third of all rows, and one that fails for long stretches.
    rows += [(100, t, f"u{t}", f"r{t}") for t in range(700)]
    rows += [(101, t, f"u{t}", f"r{t}" if t % 50 < 3 else None) for t in range(300)]
    df = spark.createDataFrame(rows, SESSION_INPUT).repartition(partitions)
    got, want = contexts(turn_context(df, span=span)), simulate(rows)
    assert got == want
    assert max(len(v) for v in got.values()) == 22


@pytest.mark.parametrize("answered,history", [(9, 18), (10, 20), (11, 20), (12, 20)])
def test_history_bound(spark, answered, history):
    rows = [(1, t, f"u{t}", f"r{t}") for t in range(answered)] + [(1, answered, "next", None)]
    got = contexts(turn_context(spark.createDataFrame(rows, SESSION_INPUT)))
    assert len(got[1, answered]) == history + 2


def test_clear_keeps_system_and_exit_ends(spark):
    rows = [(1, 0, "/system x", None), (1, 1, "a", "b"), (1, 2, "/clear", None), (1, 3, "c", "d"),
            (1, 4, "/exit", None), (1, 5, "e", "f")]
    got = contexts(turn_context(spark.createDataFrame(rows, SESSION_INPUT)))
    assert got == {(1, 1): [("system", "x"), ("user", "a")], (1, 3): [("system", "x"), ("user", "c")]}


def test_no_default_system(spark):
    rows = [(1, 0, "a", "b")]
    got = contexts(turn_context(spark.createDataFrame(rows, SESSION_INPUT), default_system=""))
    assert got == {(1, 0): [("user", "a")]}


def test_commands(spark):
    texts = ["/CLEAR", "/quit now", "/system", "/System Be Brief", "/Exit", "hello"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).withColumn("s", strip("t"))
    rows = df.select(classify_command("s"), command_argument("s")).collect()
    assert [r[0] for r in rows] == ["clear", "turn", "turn", "system", "exit", "turn"]
    assert rows[3][1] == "Be Brief"


def test_state_counts(spark):
    rows = [(1, 0, "a", "b"), (1, 1, "/clear", None), (1, 2, "c", None), (1, 3, "d", "e"), (1, 4, "f", None)]
    got = session_state(spark.createDataFrame(rows, SESSION_INPUT), span=2).orderBy("turn").collect()
    assert [(r["epoch"], r["k"]) for r in got] == [(0, 0), (1, 1), (1, 1), (1, 1), (1, 2)]


def run(stream, out, checkpoint):
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    q.awaitTermination()


def test_stream_equals_simulation_over_a_restart(spark, tmp_path):
    rows = random_sessions(30, 50, seed=3)
    inputs = str(tmp_path / "in")

    def add(low, high):
        part = [r for r in rows if low <= r[1] < high]
        spark.createDataFrame(part, SESSION_INPUT).coalesce(1).write.mode("append").parquet(inputs)

    def go():
        stream = chat_contexts(readers.session_inputs(spark, inputs, files_per_batch=1))
        run(stream, str(tmp_path / "out"), str(tmp_path / "state"))

    add(0, 10)
    add(10, 20)
    go()
    add(20, 35)
    add(35, 60)
    go()
    assert contexts(spark.read.parquet(str(tmp_path / "out"))) == simulate(rows)


def test_response_stream_any_order(spark, tmp_path):
    rows = [(i, s, f"t{i}.{s} ", s == 9) for i in range(20) for s in range(10)]
    random.Random(1).shuffle(rows)
    inputs = str(tmp_path / "in")
    schema = "id bigint, seq int, token string, is_last boolean"
    for k in range(4):
        spark.createDataFrame(rows[k * 50:(k + 1) * 50], schema).coalesce(1).write.mode("append").parquet(inputs)
    run(responses(readers.token_rows(spark, inputs, 1)), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r["id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {i: "".join(f"t{i}.{s} " for s in range(10)) for i in range(20)}


def test_late_lines_are_dropped(spark, tmp_path):
    from chatweave.streaming.telemetry import memory_peaks

    inputs = str(tmp_path / "in")

    def add(*times):
        rows = [(t, f"[Rank 0] [MEM:START] GPU0: {i + 1}MB / 100MB") for i, t in enumerate(times)]
        df = spark.createDataFrame(rows, "ts string, line string")
        df.select(F.to_timestamp("ts").alias("ingest_ts"), "line").coalesce(1).write.mode("append").parquet(inputs)

    def go():
        stream = memory_peaks(readers.telemetry_lines(spark, inputs, 1), "1 hour", "10 minutes")
        run(stream, str(tmp_path / "out"), str(tmp_path / "state"))

    add("2024-01-01 00:10:00", "2024-01-01 00:20:00")
    add("2024-01-01 05:00:00")
    go()
    add("2024-01-01 00:30:00")
    add("2024-01-01 09:00:00")
    go()
    got = {str(r["window_start"]): (r["peak_mb"], r["n_lines"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["2024-01-01 00:00:00"] == (2, 2)
    assert got["2024-01-01 05:00:00"] == (1, 1)
