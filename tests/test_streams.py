"""Streams with repeats, late rows, restarts and idle keys."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from chatweave.operators.sessions import idle_contexts
from chatweave.schemas import SESSION_INPUT
from chatweave.streaming import readers
from chatweave.streaming.run import rocksdb_state
from chatweave.streaming.state import add_numbers, chat_contexts, responses
from test_sessions import random_sessions, simulate

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
FAR = START + timedelta(days=3000)


class Stream:
    """A stream over files that are added between its runs."""

    def __init__(self, spark, folder, schema, build):
        self.spark, self.folder, self.schema, self.build = spark, str(folder), schema, build

    def add(self, rows, files=1):
        df = self.spark.createDataFrame(rows, self.schema)
        df.repartition(files).write.mode("append").parquet(f"{self.folder}/in")

    def go(self):
        with rocksdb_state(self.spark):
            q = self.build(f"{self.folder}/in").writeStream.format("parquet").option("path", f"{self.folder}/out").option(
                "checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
            q.awaitTermination()
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    def rows(self):
        return self.spark.read.parquet(f"{self.folder}/out").collect()


def test_number_runs():
    runs, new = add_numbers([], [3, 1, 2, 2])
    assert runs == [[1, 3]] and new == [1, 2, 3]
    runs, new = add_numbers(runs, [5, 1, 7, 6])
    assert runs == [[1, 3], [5, 7]] and new == [5, 6, 7]
    assert add_numbers(runs, [4, 0]) == ([[0, 7]], [0, 4])
    rng = random.Random(1)
    held, runs = set(), []
    for _ in range(200):
        some = [rng.randrange(60) for _ in range(rng.randrange(4))]
        runs, new = add_numbers(runs, some)
        assert new == sorted(set(some) - held)
        held |= set(some)
        assert held == {n for a, b in runs for n in range(a, b + 1)}
        assert all(x[1] + 1 < y[0] for x, y in zip(runs, runs[1:]))


TOKENS = "id bigint, seq int, token string, is_last boolean, at timestamp"


def token(i, s, n, text=None):
    return (i, s, text or ("<|end|>" if s == n - 1 else f"t{i}.{s} "), s == n - 1, START + timedelta(seconds=s))


def test_responses_end_once_and_leave_no_state(spark, tmp_path):
    stream = Stream(spark, tmp_path, TOKENS, lambda path: responses(
        readers.token_rows(spark, path, 1, at="at"), ["<|end|>", "t3.1 "], "at", "1 day", "1 hour"))
    rows = [token(i, s, 6) for i in range(8) for s in range(6)]
    rows = [r for r in rows if not (r[0] == 7 and r[1] in (2, 5))]  # a response without its end and a token
    random.Random(2).shuffle(rows)
    stream.add(rows[:30], 2)
    stream.go()
    # Every token again, some three times; one of a response comes with another text, too late to count.
    stream.add(rows + rows[:10] + [token(0, 3, 6, "other")], 3)
    assert stream.go() > 0
    done = {r.id: (r.text, r.n_tokens, r.complete) for r in stream.rows()}
    want = {i: ("".join(f"t{i}.{s} " for s in range(5) if (i, s) != (3, 1)), 6, True) for i in range(7)}
    assert done == want and len(stream.rows()) == 7
    stream.add([(99, 0, "x", False, FAR)])
    stream.go()
    got = {r.id: (r.text, r.n_tokens, r.complete) for r in stream.rows()}
    assert got == {**want, 7: ("t7.0 t7.1 t7.3 t7.4 ", 4, False)} and len(stream.rows()) == 8
    stream.add([token(1, 0, 6), token(7, 2, 6)])  # late: dropped
    # What is left is the one open response: its token, what is known of it, its timer.
    assert stream.go() <= 3 and len(stream.rows()) == 8
    stream.add([(99, 1, "y", True, FAR), (100, 0, "x", False, FAR + timedelta(days=9))])
    stream.go()
    assert {r.id: r.text for r in stream.rows()}[99] == "xy"


def test_responses_by_processing_time(spark, tmp_path):
    schema = "id bigint, seq int, token string, is_last boolean"
    plan = responses(readers.token_rows(spark, str(tmp_path), 1), idle="10 minutes")
    assert plan.isStreaming and [f"{n} {t}" for n, t in plan.dtypes] == ["id bigint", "text string", "n_tokens bigint", "complete boolean"]
    # Without a clock a response ends with its last token, repeated or not.
    stream = Stream(spark, tmp_path / "plain", schema, lambda path: responses(readers.token_rows(spark, path, 1)))
    rows = [(1, s, f"{s}", s == 3) for s in range(4)]
    stream.add(rows[:2] + rows[:2])
    stream.go()
    stream.add(rows[1:])
    assert stream.go() == 0
    assert [(r.text, r.n_tokens) for r in stream.rows()] == [("0123", 4)]


def test_open_responses_share_rows_of_state(spark, tmp_path):
    # A row of state a bucket, however many responses are open; ids beyond a double's digits next to a null one.
    first = 2**62 + 1
    stream = Stream(spark, tmp_path, "id bigint, seq int, token string, is_last boolean",
                    lambda path: responses(readers.token_rows(spark, path, 1), buckets=4))
    ids = [*range(first, first + 99), None]
    stream.add([(i, s, f"{i}.{s} ", s == 3) for i in ids for s in (1, 3)])
    assert 1 <= stream.go() <= 4 and not stream.rows()
    stream.add([(i, s, f"{i}.{s} ", False) for i in ids for s in (2, 0)], 2)
    assert stream.go() == 0
    assert {r.id: r.text for r in stream.rows()} == {i: "".join(f"{i}.{s} " for s in range(4)) for i in ids}
    assert len(stream.rows()) == 100


INPUTS = f"{SESSION_INPUT}, at timestamp"


def timed(rows, pause=()):
    """Inputs with times: a minute a turn, and three hours more after each turn in ``pause``."""
    return [(c, t, x, r, START + timedelta(minutes=t, hours=3 * sum(t > p for p in pause))) for c, t, x, r in rows]


def sessions(rows, idle=timedelta(hours=1)):
    """What sessions send that end when idle: each stretch is a session of its own."""
    out, last, part = {}, {}, {}
    split = []
    for c, t, x, r, at in sorted(rows, key=lambda r: r[:2]):
        if not x.strip():
            continue
        if c in last and at - last[c] > idle:
            part[c] = part.get(c, 0) + 1
        last[c] = at
        split.append(((c, part.get(c, 0)), t, x, r))
    for (key, t), messages in simulate(split).items():
        out[key[0], t] = messages
    return out


def contexts(rows):
    return {(r["conv_id"], r["turn"]): [(m["role"], m["content"]) for m in r["messages"]] for r in rows}


def test_sessions_in_any_order_with_repeats_and_pauses(spark, tmp_path):
    rows = timed(random_sessions(12, 60, seed=5, failing=0.1), pause=(10, 11, 35))
    stream = Stream(spark, tmp_path, INPUTS, lambda path: chat_contexts(
        readers.session_inputs(spark, path, 1, at="at"), at="at", delay="20 hours", idle="1 hour"))
    rng = random.Random(6)
    rng.shuffle(rows)
    half = len(rows) // 2
    stream.add(rows[:half], 2)
    stream.go()
    stream.add(rows[half:] + rng.sample(rows, 80), 2)  # some a second or third time
    stream.go()
    assert not stream.rows()  # nothing is older than the delay
    stream.add([(-1, 0, "/exit", None, FAR)])
    stream.go()
    want = sessions(rows)
    assert contexts(stream.rows()) == want and len(stream.rows()) == len(want) and len(want) > 100
    # What is late changes nothing, and idle sessions have left no state.
    stream.add([(c, t, "late", None, at) for c, t, _, _, at in rows])
    assert stream.go() <= 3 and len(stream.rows()) == len(want)
    batch = idle_contexts(spark.createDataFrame(rows, INPUTS), "at", "1 hour", span=8)
    assert contexts(batch.collect()) == want


def test_sessions_are_released_as_the_watermark_passes(spark, tmp_path):
    rows = timed([(1, t, f"q{t}", f"a{t}") for t in range(40)])
    stream = Stream(spark, tmp_path, INPUTS, lambda path: chat_contexts(
        readers.session_inputs(spark, path, 1, at="at"), at="at", delay="10 minutes", idle="1 hour"))
    seen = []
    for k in range(4):
        part = rows[10 * k:10 * k + 10]
        random.Random(k).shuffle(part)
        stream.add(part)
        stream.go()
        seen.append(len(stream.rows()))
    # After each part all but the last ten minutes is out.
    assert seen == [0, 10, 20, 30]
    assert contexts(stream.rows()) == {k: v for k, v in sessions(rows).items() if k[1] < 30}


@pytest.mark.parametrize("bad", [0, -2, 3])
def test_history_bound_is_checked(spark, bad):
    rows = spark.createDataFrame([], SESSION_INPUT)
    with pytest.raises(ValueError):
        chat_contexts(rows, max_messages=bad)
