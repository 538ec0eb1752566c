"""Keyed state: growing responses, by buckets of them, and chat sessions.

The state of sessions needs the RocksDB store (``chatweave.streaming.run.rocksdb_state``). Timers end what has
gone idle, on one of two clocks: event time, that is the watermark of a time column,
or the time of processing. On event time results do not depend on how rows are dealt to
micro-batches.
"""

from __future__ import annotations

import io
import pickle
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from chatweave.functions.text import classify_command, command_argument, strip
from chatweave.operators.sessions import DEFAULT_SYSTEM, MAX_MESSAGES, checked_messages
from chatweave.schemas import MESSAGES


def milliseconds(interval: str) -> int:
    """An interval such as ``10 minutes`` in milliseconds."""
    return int(pd.Timedelta(interval).total_seconds() * 1000)


class Clock:
    """The time that timers of a processor go by."""

    def __init__(self, mode: str) -> None:
        self.mode = mode  # EventTime, ProcessingTime or None

    def now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.mode == "EventTime" else timers.getCurrentProcessingTimeInMs()


def add_numbers(runs: list[list[int]], numbers: Iterable[int]) -> tuple[list[list[int]], list[int]]:
    """Add numbers to a set kept as ascending runs [first, last]; also those that were new."""
    starts = [a for a, _ in runs]
    new = []
    for n in sorted(set(numbers)):
        at = bisect_right(starts, n) - 1
        if at < 0 or n > runs[at][1]:
            new.append(n)
    merged: list[list[int]] = []
    for a, b in sorted([*runs, *([n, n] for n in new)]):
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged, new


# Buckets that responses are dealt to, unless a caller knows better: each is one row of state.
BUCKETS = 1024

# What is known of the open responses of a bucket: (runs, length, last, done) by id, sequence numbers being held
# as runs and last being the time of the newest token; and (sequence number, token) pairs by id, one pickle after the other.
RESPONSES = "known binary, tokens binary"


def _taken(tokens: bytes, ids: set) -> tuple[dict, bytes]:
    """The held tokens of some responses, and what is left of ``tokens``."""
    taken: dict = {i: [] for i in ids}
    rest: dict = {}
    stream = io.BytesIO(tokens)
    while stream.tell() < len(tokens):
        for i, pairs in pickle.load(stream).items():
            (taken[i] if i in ids else rest.setdefault(i, [])).extend(pairs)
    return taken, pickle.dumps(rest, 5) if rest else b""


def _respond(group, batches: Iterator[pd.DataFrame], state: GroupState, specials: frozenset, clock: str, idle_ms: int,
             ) -> Iterator[pd.DataFrame]:
    """Responses of a bucket whose last token has come and of which none is missing, or that are idle.

    A finished response leaves a mark, so that repeated tokens do not open it again; the mark
    and what stays unfinished go when the response has been idle.
    """
    known: dict = pickle.loads(state.get[0]) if state.exists else {}
    held: bytes = state.get[1] if state.exists else b""
    now = state.getCurrentWatermarkMs() if clock == "EventTime" else state.getCurrentProcessingTimeMs() if idle_ms else 0
    first: dict = {}  # of each id the first token of each number
    ends: dict = {}
    newest: dict = {}
    for batch in () if state.hasTimedOut else batches:
        ids = [None if pd.isna(i) else i for i in batch["id"].tolist()]
        for i, s, t, end in zip(ids, batch["seq"].tolist(), batch["token"].tolist(), batch["is_last"].tolist(), strict=True):
            if i not in first:
                first[i] = {}
            first[i].setdefault(int(s), t)
            if end:
                ends.setdefault(i, int(s))
        for i, ms in zip(ids, batch["ms"].tolist() if clock == "EventTime" else ()):
            newest[i] = max(newest.get(i, ms), ms)
    added, done = {}, {}
    for i, tokens in first.items():
        runs, length, last, over = known.get(i, ([], -1, 0, False))
        last = max(last, newest.get(i, now))
        if over:
            known[i] = (runs, length, last, True)
            continue
        numbers, new = add_numbers(runs, tokens)
        length = ends[i] + 1 if i in ends else length
        pairs = [(s, tokens[s]) for s in new]
        if numbers == [[0, length - 1]]:
            done[i] = (pairs, length, True, bool(runs))
            known[i] = ([], length, last, True)
        else:
            known[i] = (numbers, length, last, False)
            if pairs:
                added[i] = pairs
    if added:
        held += pickle.dumps(added, 5)
    for i, (runs, _, last, over) in list(known.items()):
        if over if not idle_ms else last + idle_ms <= now:
            if not over:
                done[i] = ([], sum(b - a + 1 for a, b in runs), False, True)
            del known[i]
    earlier, held = _taken(held, {i for i, found in done.items() if found[3]}) if any(x[3] for x in done.values()) else ({}, held)
    if known:
        state.update((pickle.dumps(known, 5), held))
        due = min(last for _, _, last, _ in known.values()) + idle_ms
        if clock == "EventTime":
            state.setTimeoutTimestamp(due)
        elif idle_ms:
            state.setTimeoutDuration(due - now)
    elif state.exists:
        state.remove()
    if done:
        texts = ["".join(t for _, t in sorted(pairs + earlier.get(i, [])) if t not in specials) for i, (pairs, *_) in done.items()]
        yield pd.DataFrame({"id": list(done), "text": texts, "n_tokens": [n for _, n, _, _ in done.values()],
                            "complete": [c for _, _, c, _ in done.values()]})


def responses(tokens: DataFrame, specials: Sequence[str] = (), at: str | None = None, delay: str = "10 minutes",
              idle: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Texts from a stream of token rows, one row per response, without the tokens in ``specials``.

    Tokens may arrive in any order, in any number of micro-batches and several times; of those of one number the
    first counts. ``n_tokens`` counts the numbers. With ``at``, a time column, tokens more than ``delay`` behind the newest
    of the stream are dropped, and a response without tokens for ``idle`` (then 1 hour unless
    given) ends as it is, ``complete`` being false; with ``idle`` alone the same goes by the time of
    processing. With neither, a response ends with its last token only, and its state goes at once.

    State is kept by ``buckets`` of responses, as a call for each response costs more than its tokens. A micro-batch
    reads and writes the open responses of each bucket it has tokens for, so some hundred open
    responses a bucket are best; the number stays the same as long as a checkpoint is used.
    """
    clock = "EventTime" if at else "ProcessingTime" if idle else "No"
    idle_ms = milliseconds(idle or "1 hour") if at or idle else 0
    kind = dict(tokens.dtypes)["id"]
    # Ids go as texts, as pandas has no integers beside nulls.
    text = F.base64("id") if kind == "binary" else F.col("id").cast("string")
    back = F.unbase64("id") if kind == "binary" else F.col("id").cast(kind)
    columns = [F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), text.alias("id"), "seq", "token", "is_last"]
    rows = tokens.select(*columns)
    if at:
        rows = tokens.withWatermark(at, delay).select(*columns, at, F.unix_millis(F.col(at).cast("timestamp")).alias("ms"))
    return rows.groupBy("bucket").applyInPandasWithState(
        partial(_respond, specials=frozenset(specials), clock=clock, idle_ms=idle_ms),
        "id string, text string, n_tokens bigint, complete boolean", RESPONSES, "append", f"{clock}Timeout",
    ).select(back.alias("id"), "text", "n_tokens", "complete")


class ChatSession(StatefulProcessor):
    """History, system message and end mark of one session.

    Inputs come classified, so only the order-dependent part runs here. On a clock, inputs wait
    until the watermark has passed them and are then taken in order of time and turn; a
    session that is idle ends, and its next input begins a new one.
    """

    def __init__(self, default_system: str, max_messages: int, clock: Clock, idle_ms: int) -> None:
        self.default_system = default_system
        self.max_messages = checked_messages(max_messages)
        self.clock, self.idle_ms = clock, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", "role string, content string")
        # last and turn are time and number of the newest input taken; timer is the next one set.
        self.session = handle.getValueState("session", "system string, ended boolean, last bigint, turn bigint")
        self.waiting = handle.getListState("waiting", "ms bigint, turn bigint, u string, cmd string, arg string, reply string")
        self.timer = handle.getValueState("timer", "ms bigint")

    def _set_timer(self, ms: int) -> None:
        before = self.timer.get()[0] if self.timer.exists() else None
        if before is not None and before <= ms:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def _take(self, key, inputs: list[tuple]) -> Iterator[pd.DataFrame]:
        """Inputs (ms, turn, text, command, argument, reply) in order, all newer than those before."""
        known = self.session.exists()
        system, ended, last, newest = self.session.get() if known else (self.default_system, False, None, None)
        history = [tuple(x) for x in self.history.get()] if known and self.history.exists() else []
        out = []
        for ms, turn, text, cmd, arg, reply in inputs:
            if newest is not None and (ms, turn) <= (last, newest):
                continue  # a repeat
            if self.idle_ms and last is not None and ms > last + self.idle_ms:
                system, ended, history = self.default_system, False, []
            last, newest = ms, turn
            if ended:
                continue
            if cmd == "exit":
                ended, history = True, []
            elif cmd in ("clear", "system"):
                history = []
                system = arg if cmd == "system" else system
            else:
                head = [("system", system)] if system else []
                sent = [*head, *history, ("user", text)]
                out.append((key[0], turn, [{"role": r, "content": c} for r, c in sent]))
                if not pd.isna(reply):
                    history = [*history, ("user", text), ("assistant", reply)][-self.max_messages:]
        self.session.update((system, ended, last, newest))
        if history:
            self.history.put(history)
        else:
            self.history.clear()
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "turn", "messages"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["ms", "turn"])
        columns = [batch[c] for c in ("ms", "turn", "u", "cmd", "sys_arg", "reply")]
        inputs = [(*r[:4], *(None if pd.isna(x) else x for x in r[4:])) for r in zip(*columns, strict=True)]
        if self.clock.mode == "None":
            yield from self._take(key, inputs)
            return
        self.waiting.appendList(inputs)
        self._set_timer(inputs[0][0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self.clock.now(timerValues)
        self.timer.clear()
        waiting = sorted((tuple(x) for x in self.waiting.get()), key=lambda r: r[:2]) if self.waiting.exists() else []
        due = [r for r in waiting if r[0] <= now]
        if due:
            yield from self._take(key, due)
            waiting = waiting[len(due):]
            if waiting:
                self.waiting.put(waiting)
            else:
                self.waiting.clear()
        if waiting:
            self._set_timer(waiting[0][0])
        elif self.session.exists():
            end = self.session.get()[2] + self.idle_ms
            if end > now:
                self._set_timer(end)
            else:  # nothing older than the watermark can come
                self.session.clear()
                self.history.clear()

    def close(self) -> None:
        pass


def chat_contexts(
    inputs: DataFrame, default_system: str = DEFAULT_SYSTEM, max_messages: int = MAX_MESSAGES,
    at: str | None = None, delay: str = "10 minutes", idle: str = "1 day",
) -> DataFrame:
    """The message list for each user turn of a stream of session inputs.

    With ``at``, a time column, the inputs of a session are taken in order of time and turn, in whatever
    order and however often they arrive: each waits until the watermark, ``delay`` behind the newest
    input of the stream, has passed it; what comes later than that is dropped. A session ends
    when it gets no input for ``idle``: the next one starts with an empty history and the default system
    message, also after an exit, and an idle session leaves no state.

    Without ``at`` rows are taken in turn order inside a micro-batch and in arrival
    order across micro-batches, once each, and sessions do not end. Stripping and classification stay in the JVM.
    """
    stripped = inputs.withColumn("u", strip("text")).filter(F.col("u") != "")
    ms = F.unix_millis(F.col(at).cast("timestamp")) if at else F.lit(0).cast("bigint")
    if at:
        stripped = stripped.withWatermark(at, delay)
    kinds = stripped.withColumn("cmd", classify_command("u")).select(
        "conv_id", "turn", "u", "cmd",
        F.when(F.col("cmd") == "system", command_argument("u")).alias("sys_arg"), "reply", ms.alias("ms"), *([at] if at else []),
    )
    mode = "EventTime" if at else "None"
    return kinds.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=ChatSession(default_system, max_messages, Clock(mode), milliseconds(idle) if at else 0),
        outputStructType=f"conv_id {dict(inputs.dtypes)['conv_id']}, turn bigint, messages {MESSAGES}",
        outputMode="Append",
        timeMode=mode,
    )
