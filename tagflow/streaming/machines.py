"""Per-key logic of the stateful streams.

A machine sees the rows of one key in order and may set ``due`` (ns) in its
state to be called again at that time. At the end of the input it gives out what
is left (``end``). States are small picklable dicts; one that is as good as a new
one (``idle``) is not kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from tagflow.operators.hj212 import feed

NS_PER_MS = 1_000_000


class Machine:
    def row(self, state: dict, ts: int, values: tuple) -> list[tuple]:
        raise NotImplementedError

    def alarm(self, state: dict) -> list[tuple]:
        return []

    def end(self, state: dict) -> list[tuple]:
        return []

    def idle(self, state: dict) -> bool:
        return False


@dataclass(frozen=True)
class Timer(Machine):
    """Values: input, delay in ms, then the row's own columns. Output: own columns, ts, kind, q."""

    on_delay: bool

    def row(self, state, ts, values):
        signal, ms, *own = values
        if signal != state.get("in", False):
            state["in"] = signal
            if signal == self.on_delay and ms > 0:
                state.update(due=ts + ms * NS_PER_MS, row=own)
            else:
                state.update(due=None, q=signal)
        return [(*own, ts, "input", state.get("q", False))]

    def alarm(self, state):
        at, state["due"], state["q"] = state["due"], None, self.on_delay
        return [(*state.pop("row"), at, "commit", self.on_delay)]

    def idle(self, state):
        return state.get("due") is None and not state.get("in") and not state.get("q")


@dataclass(frozen=True)
class Watchdog(Machine):
    """Values: timeout in ms, seq, data. Output: seq, data, ts, kind."""

    failsafe: str

    def row(self, state, ts, values):
        ms, seq, data = values
        state["due"] = ts + ms * NS_PER_MS if ms > 0 else None
        return [(seq, data, ts, "input")]

    def alarm(self, state):
        at, state["due"] = state["due"], None
        return [(None, self.failsafe, at, "failsafe")]

    def idle(self, state):
        return state.get("due") is None


@dataclass(frozen=True)
class Changes(Machine):
    """Values: value, seq. Output: seq, ts, value, previous."""

    epsilon: float

    def row(self, state, ts, values):
        value, seq = values
        first = "last" not in state
        before = state.get("last")
        state["last"] = value
        if value is None or before is None:
            moved = (value is None) != (before is None)
        else:
            moved = abs(value - before) > self.epsilon
        return [(seq, ts, value, before)] if first or moved else []


@dataclass(frozen=True)
class CountWindow(Machine):
    """Values: value. Output: window number, first and last time, count, sum, average, min, max, complete."""

    n: int

    def row(self, state, ts, values):
        (value,) = values
        if state.get("n", 0) == 0:
            state.update(n=0, known=0, sum=0.0, low=None, high=None, start=ts)
        state["n"] += 1
        state["stop"] = ts
        if value is not None:
            state["known"] += 1
            state["sum"] += value
            state["low"] = value if state["low"] is None else min(state["low"], value)
            state["high"] = value if state["high"] is None else max(state["high"], value)
        return self._close(state) if state["n"] == self.n else []

    def _close(self, state):
        number = state.get("number", 0)
        average = state["sum"] / state["known"] if state["known"] else None
        total = state["sum"] if state["known"] else None
        out = (number, state["start"], state["stop"], state["n"], total, average, state["low"], state["high"], state["n"] == self.n)
        state.update(n=0, number=number + 1)
        return [out]

    def end(self, state):
        return self._close(state) if state.get("n") else []


@dataclass(frozen=True)
class SequenceMatch(Machine):
    """Values: one flag per step. Output: first and last time of a match."""

    steps: int
    within_ns: int

    def row(self, state, ts, flags):
        waiting = state.setdefault("waiting", [[] for _ in range(self.steps)])
        waiting[:] = [[s for s in starts if ts - s <= self.within_ns] for starts in waiting]
        last = self.steps - 1
        for i in range(last, 0, -1):
            if not flags[i]:
                continue
            moving, waiting[i] = waiting[i], []
            if i < last:
                waiting[i + 1] += moving
            elif moving:
                state["waiting"] = [[] for _ in range(self.steps)]
                return [(min(moving), ts)]
        if flags[0]:
            if last == 0:
                return [(ts, ts)]
            waiting[1].append(ts)
        return []

    def idle(self, state):
        return not any(state.get("waiting", ()))


@dataclass(frozen=True)
class Frames(Machine):
    """Values: seq, bytes. Output: seq, frame number, bytes."""

    def row(self, state, ts, values):
        seq, data = values
        state["rest"], found = feed(state.get("rest", b""), bytes(data or b""))
        return [(seq, i, f) for i, f in enumerate(f for f, reason in found if reason is None)]

    def idle(self, state):
        return not state.get("rest")
