"""Keyed streams with state and timers.

``clock='event'`` holds rows until the watermark has passed them, so rows of a
key are handled in time order whatever order they arrive in, and a replay gives
the batch operator's result up to the watermark. Timers fire as the watermark
moves: a stream that falls silent altogether does not move it. For live alarms
use ``clock='processing'``, where rows count when they arrive.

End of input: one row of any key whose time is ``MARK_NS`` moves the watermark
behind everything (``end_mark`` gives its time). All waiting rows and timers of all
keys are then settled, open count windows come out as incomplete ones, and no state
stays; the mark itself gives no row. A replay that ends with it gives the batch
operator's result in full.

A few waiting rows of a key stay with its state; more wait in a map, in parts of rows in
order, so a timer reads only parts whose time has come and a row takes no state call of its own.
Rows at or before the watermark are dropped by Spark as late ones.

The session needs the RocksDB state store provider (see ``build_session``).
State is partitioned by key; one key's rows are handled by one task, which the
per-key order of these operators requires.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tagflow.functions import text as X
from tagflow.functions.text import parse_duration_ms
from tagflow.operators.control import NS_PER_MS, control_failures
from tagflow.operators.windows import END_NS, MARK_NS, before_end
from tagflow.streaming import machines as K


# Waiting rows of a key that stay with its state; more go into the map in parts of this many.
PART_ROWS = 512
# Rows put in order together before they are cut into parts.
GATHER_ROWS = 1 << 16
# Rows given out together.
OUT_ROWS = 10_000


def _in_order(row: tuple) -> tuple:
    return row[:2]


class Runner(StatefulProcessor):
    """Feeds a machine and keeps its state, its waiting rows and its timer.

    The state holds ``_rows``, the waiting rows that fill no part, and ``_parts``, (first time,
    number) of the parts in the map, besides what the machine keeps.
    """

    def __init__(self, machine: K.Machine, keys: Sequence[str], out: Sequence[str], event_clock: bool):
        self.machine = machine
        self.keys = list(keys)
        self.out = list(out)
        self.event_clock = event_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "data binary")
        self.waiting = handle.getMapState("waiting", "bucket bigint", "data binary")

    def close(self) -> None:
        pass

    def _load(self) -> dict:
        held = self.state.get()
        return pickle.loads(held[0]) if held is not None else {}

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in rows], columns=[*self.keys, *self.out])

    @staticmethod
    def _tuples(pdf: pd.DataFrame) -> list[tuple]:
        """(ts, tie, values) rows."""
        rows = zip(pdf["row_ts"].tolist(), pdf["row_tie"].tolist(), pdf["row_cells"].tolist())
        return [(t, s, tuple(v.values()) if isinstance(v, dict) else tuple(v)) for t, s, v in rows]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._load()
        if self.event_clock:
            first = self._wait(state, (self._tuples(pdf) for pdf in rows if len(pdf)))
            if first is not None:
                self.state.update((pickle.dumps(state),))
                self.handle.registerTimer(self._ms(first))
            return
        arrived = [r for pdf in rows if len(pdf) for r in self._tuples(pdf)]
        if not arrived:
            return
        now = timerValues.getCurrentProcessingTimeInMs() * NS_PER_MS
        armed = state.get("due")
        out = []
        for _, _, values in sorted(arrived, key=_in_order):
            out += self.machine.row(state, now, values)
        self.state.update((pickle.dumps(state),))
        if state.get("due") is not None and state["due"] != armed:
            self.handle.registerTimer(self._ms(state["due"]))
        if out:
            yield self._frame(key, out)

    def _wait(self, state: dict, arrived: Iterator[list[tuple]]) -> int | None:
        """Puts rows aside and returns the earliest time of them."""
        held, first = state.get("_rows", []), None
        for rows in arrived:
            earliest = min(r[0] for r in rows)
            first = earliest if first is None else min(first, earliest)
            held = held + rows
            if len(held) >= GATHER_ROWS:
                held = self._put_away(state, held)
        state["_rows"] = self._put_away(state, held) if len(held) > PART_ROWS else held
        return first

    def _put_away(self, state: dict, rows: list[tuple]) -> list[tuple]:
        """Cuts rows in order into whole parts; returns those left over."""
        rows = sorted(rows, key=_in_order)
        whole = len(rows) - len(rows) % PART_ROWS
        parts, number = state.setdefault("_parts", []), state.get("_next", 0)
        for at in range(0, whole, PART_ROWS):
            self.waiting.updateValue((number,), (pickle.dumps(rows[at : at + PART_ROWS]),))
            parts.append((rows[at][0], number))
            number += 1
        state["_next"] = number
        return rows[whole:]

    def _due_rows(self, state: dict, limit: int) -> Iterator[tuple]:
        """Waiting rows up to ``limit`` in order; a part is read when its first row's turn comes."""
        held, parts = state.get("_rows", []), state.get("_parts", [])
        state["_rows"] = [r for r in held if r[0] > limit]
        due = sorted((r for r in held if r[0] <= limit), key=_in_order)
        ready = sorted(p for p in parts if p[0] <= limit)
        if not ready:
            yield from due
            return
        state["_parts"] = [p for p in parts if p[0] > limit]
        ahead: list[tuple] = []  # (place of the next row, number, the row, the rows behind it)

        def put(number: int, rows: Iterator[tuple]) -> None:
            row = next(rows, None)
            if row is not None:
                heapq.heappush(ahead, (row[:2], number, row, rows))

        put(-1, iter(due))
        opened = 0
        while ahead or opened < len(ready):
            while opened < len(ready) and (not ahead or ready[opened][0] <= ahead[0][0][0]):
                number = ready[opened][1]
                put(number, iter(self._taken(state, number, limit)))
                opened += 1
            _, number, row, rows = heapq.heappop(ahead)
            yield row
            put(number, rows)

    def _taken(self, state: dict, number: int, limit: int) -> list[tuple]:
        """Rows of a part up to ``limit``; the others stay in it."""
        rows = pickle.loads(self.waiting.getValue((number,))[0])
        later = [r for r in rows if r[0] > limit]
        if later:
            self.waiting.updateValue((number,), (pickle.dumps(later),))
            state["_parts"].append((later[0][0], number))
        else:
            self.waiting.removeKey((number,))
        return [r for r in rows if r[0] <= limit]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._load()
        ended = self.event_clock and timerValues.getCurrentWatermarkInMs() * NS_PER_MS >= END_NS
        if self.event_clock:
            limit = timerValues.getCurrentWatermarkInMs() * NS_PER_MS
        else:
            limit = timerValues.getCurrentProcessingTimeInMs() * NS_PER_MS
        out: list[tuple] = []
        for ts, _, values in self._due_rows(state, limit) if self.event_clock else ():
            if state.get("due") is not None and state["due"] < ts:
                out += self.machine.alarm(state)
            out += self.machine.row(state, ts, values)
            if len(out) >= OUT_ROWS:
                yield self._frame(key, out)
                out = []
        if state.get("due") is not None and state["due"] <= limit:
            out += self.machine.alarm(state)
        left = [r[0] for r in state.get("_rows", ())] + [p[0] for p in state.get("_parts", ())]
        if ended:
            out += self.machine.end(state)
            self.state.clear()
        elif self.machine.idle(state) and not left:
            self.state.clear()
            if state.get("ends"):
                self.handle.deleteTimer(self._ms(END_NS))
        else:
            if left:
                self.handle.registerTimer(self._ms(min(left)))
            if state.get("due") is not None:
                self.handle.registerTimer(self._ms(state["due"]))
            if self.event_clock and not state.get("ends"):
                state["ends"] = True
                self.handle.registerTimer(self._ms(END_NS))
            self.state.update((pickle.dumps(state),))
        if out:
            yield self._frame(key, out)

    @staticmethod
    def _ms(ns: int) -> int:
        return -(-ns // NS_PER_MS)


def run_machine(
    stream: DataFrame,
    machine: K.Machine,
    keys: Sequence[str],
    ts: str,
    seq: str,
    values: Sequence[Column],
    out: str,
    delay: str = "0s",
    clock: str = "event",
) -> DataFrame:
    """Run a machine over a keyed stream. ``out`` is the schema after the keys."""
    if clock not in ("event", "processing"):
        raise ValueError("clock is 'event' or 'processing'")
    types = dict(stream.dtypes)
    micros = F.call_function("div", F.col(ts), F.lit(1000).cast("bigint"))
    # Round up to the next microsecond so that no row looks older than it is.
    at = F.timestamp_micros(micros + F.when(F.col(ts) % 1000 > 0, 1).otherwise(0))
    shaped = stream.select(
        *keys, F.col(ts).alias("row_ts"), F.col(seq).cast("bigint").alias("row_tie"), at.alias("row_time"),
        F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]).alias("row_cells"),
    )
    event = clock == "event"
    if event:
        ms = parse_duration_ms(delay)
        # The mark moves the watermark and then goes.
        shaped = before_end(shaped.withWatermark("row_time", f"{ms} milliseconds"), "row_time")
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), out])
    names = [c.split()[0] for c in out.split(", ")]
    return shaped.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Runner(machine, keys, names, event),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if event else "ProcessingTime",
    )


def _timer(stream, on_delay, keys, ts, seq, input_col, pt, delay, clock):
    usable, _ = control_failures(stream, pt)
    signal = F.col(input_col)
    if dict(stream.dtypes)[input_col] == "string":
        signal = X.to_bool(signal)
    return run_machine(
        usable, K.Timer(on_delay), keys, ts, seq,
        [F.coalesce(signal, F.lit(False)), F.col("_ms"), F.col(seq).cast("bigint")],
        f"{seq} bigint, {ts} bigint, kind string, q boolean", delay, clock,
    )


def timer_ton_stream(stream: DataFrame, keys=("device",), ts="ts_ns", seq="seq", input_col="input", pt="pt",
                     delay="0s", clock="event") -> DataFrame:
    """Streaming on-delay: keys, seq, time, kind (input or commit) and q."""
    return _timer(stream, True, keys, ts, seq, input_col, pt, delay, clock)


def timer_tof_stream(stream: DataFrame, keys=("device",), ts="ts_ns", seq="seq", input_col="input", pt="pt",
                     delay="0s", clock="event") -> DataFrame:
    """Streaming off-delay."""
    return _timer(stream, False, keys, ts, seq, input_col, pt, delay, clock)


def watchdog_stream(stream: DataFrame, failsafe: str, keys=("device",), ts="ts_ns", seq="seq", timeout="timeout",
                    data_col="data", delay="0s", clock="event") -> DataFrame:
    """Streaming watchdog: every row, and the failsafe text where none came in time."""
    if not failsafe.strip():
        raise ValueError("failsafe is required")
    usable, _ = control_failures(stream, timeout)
    return run_machine(
        usable, K.Watchdog(failsafe), keys, ts, seq, [F.col("_ms"), F.col(seq).cast("bigint"), F.col(data_col)],
        f"{seq} bigint, {data_col} string, {ts} bigint, kind string", delay, clock,
    )


def changes_stream(stream: DataFrame, keys=("name",), ts="ts_ns", seq="seq", value="value", epsilon=0.0,
                   delay="0s", clock="event") -> DataFrame:
    """Streaming change detection: seq, time, value, previous."""
    return run_machine(
        stream, K.Changes(epsilon), keys, ts, seq, [F.col(value).cast("double"), F.col(seq).cast("bigint")],
        f"{seq} bigint, {ts} bigint, {value} double, previous double", delay, clock,
    )


def count_window_stream(stream: DataFrame, n: int, keys=("name",), ts="ts_ns", seq="seq", value="value",
                        delay="0s", clock="event") -> DataFrame:
    """Streaming count windows of n rows: number, times and the usual aggregates of ``value``;
    ``complete`` is false for a shorter one that the end of input closes."""
    return run_machine(
        stream, K.CountWindow(n), keys, ts, seq, [F.col(value).cast("double")],
        "window_no bigint, start_ns bigint, end_ns bigint, n bigint, sum double, avg double, min double, max double, complete boolean",
        delay, clock,
    )


def sequence_match_stream(stream: DataFrame, steps: Sequence[str], within: str, keys=("device",), ts="ts_ns",
                          seq="seq", delay="0s", clock="event") -> DataFrame:
    """Streaming sequence matches: first and last time."""
    flags = [F.coalesce(F.expr(p), F.lit(False)) for p in steps]
    machine = K.SequenceMatch(len(steps), parse_duration_ms(within) * NS_PER_MS)
    return run_machine(stream, machine, keys, ts, seq, flags, "start_ts_ns bigint, end_ts_ns bigint", delay, clock)


def split_frames_stream(stream: DataFrame, keys=("conn",), ts="ts_ns", seq="seq", payload="bytes",
                        delay="0s", clock="event") -> DataFrame:
    """Streaming reassembly of connection bytes into frames."""
    return run_machine(
        stream, K.Frames(), keys, ts, seq, [F.col(seq).cast("bigint"), F.col(payload)],
        f"{seq} bigint, frame_no int, bytes binary", delay, clock,
    )


def end_mark() -> Column:
    """Time of the row that ends the input, as a timestamp."""
    return F.timestamp_micros(F.lit(MARK_NS // 1000).cast("bigint"))


__all__ = [
    "changes_stream",
    "count_window_stream",
    "end_mark",
    "run_machine",
    "sequence_match_stream",
    "split_frames_stream",
    "timer_tof_stream",
    "timer_ton_stream",
    "watchdog_stream",
]
