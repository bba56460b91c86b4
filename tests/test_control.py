from __future__ import annotations

import pytest

from tagflow.operators import control

MS = 1_000_000
FAILSAFE = '{"v":0}'


def signal(spark, *rows):
    return spark.createDataFrame(
        [("d", t * MS, i, s, pt, "{}") for i, (t, s, pt) in enumerate(rows)],
        "device string, ts_ns long, seq long, input string, pt string, data string",
    )


def run(df):
    return [(r["ts_ns"] // MS, r["kind"], r["q"]) for r in df.orderBy("ts_ns", "kind").collect()]


def test_ton_holds_then_commits(spark):
    df = signal(spark, (0, "true", "200ms"), (100, "true", "200ms"), (300, "1", "200ms"))
    assert run(control.timer_ton(df)) == [(0, "input", False), (100, "input", False), (200, "commit", True), (300, "input", True)]


def test_ton_early_drop_and_rearm(spark):
    df = signal(spark, (0, "true", "200ms"), (100, "false", "200ms"), (500, "true", "200ms"))
    assert run(control.timer_ton(df)) == [
        (0, "input", False), (100, "input", False), (500, "input", False), (700, "commit", True),
    ]
    assert run(control.timer_ton(df, as_of_ns=699 * MS))[-1] == (500, "input", False)


def test_ton_tie_and_zero_delay(spark):
    tie = signal(spark, (0, "true", "200ms"), (200, "false", "200ms"))
    assert run(control.timer_ton(tie)) == [(0, "input", False), (200, "input", False)]
    zero = signal(spark, (0, "true", "0s"), (1, "true", "1h"), (2, "0", "0s"))
    assert run(control.timer_ton(zero)) == [(0, "input", True), (1, "input", True), (2, "input", False)]


def test_tof_mirrors(spark):
    df = signal(spark, (0, "true", "200ms"), (100, "false", "200ms"), (150, "false", "200ms"), (400, "false", "200ms"))
    assert run(control.timer_tof(df)) == [
        (0, "input", True), (100, "input", True), (150, "input", True), (300, "commit", False), (400, "input", False),
    ]
    kept = signal(spark, (0, "true", "200ms"), (100, "false", "200ms"), (250, "true", "200ms"))
    assert [q for _, _, q in run(control.timer_tof(kept))] == [True, True, True]


def test_unreadable_durations_touch_nothing(spark):
    df = signal(spark, (0, "true", "200ms"), (100, "false", "bad"), (150, "true", "200ms"))
    assert run(control.timer_ton(df)) == [(0, "input", False), (150, "input", False), (200, "commit", True)]
    _, failures = control.control_failures(df, "pt")
    assert [(r["ts_ns"], r["reason"]) for r in failures.collect()] == [(100 * MS, "invalid duration")]


def test_watchdog(spark):
    df = signal(spark, (0, "1", ""), (50, "1", ""), (100, "1", ""), (150, "1", ""))
    got = control.watchdog(df, FAILSAFE, timeout="300ms").orderBy("ts_ns").collect()
    assert [(r["ts_ns"] // MS, r["kind"], r["data"]) for r in got[3:]] == [(150, "input", "{}"), (450, "failsafe", FAILSAFE)]
    assert control.watchdog(df, FAILSAFE, timeout="300ms", as_of_ns=449 * MS).count() == 4
    tie = signal(spark, (0, "1", ""), (300, "1", ""))
    assert control.watchdog(tie, FAILSAFE, timeout="300ms", as_of_ns=300 * MS).count() == 2
    assert control.watchdog(tie, FAILSAFE, timeout="0s").count() == 2
    with pytest.raises(ValueError):
        control.watchdog(tie, " ")
