"""Files arriving over several batches give the batch operator's rows."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from entry_queries.streams import PROVIDER, replay
from tagflow.operators import control, sequence
from tagflow.operators import windows as W
from tagflow.operators.series import valid_fields
from tagflow.sources import store
from tagflow.functions import values as V
from tagflow.streaming import stateful

MS = 1_000_000
SCHEMA = "device long, ts_ns long, seq long, input string, pt string, k long, name string, data string"


def source(spark, folder, late=False):
    """Three files of rows; the last row of each key lies far ahead and moves the watermark."""
    path = str(folder / f"in-{uuid.uuid4().hex}")
    rows = [
        (i % 4, (1000 + i * 137 % 600 + (i // 60) * 600) * MS, i, "true" if i * 7 % 5 < 3 else "0", "bad" if i % 31 == 0 else "90ms", i * 13 % 40, "abc"[i % 3], f"{i}")
        for i in range(180)
    ]
    end = [(d, 10**6 * MS, 1000 + d, "0", "0s", 0, "z", "end") for d in range(4)]
    for part in (rows[:60], rows[60:120], rows[120:] + end):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return batch, stream


def same(batch, stream, columns, until=10**6 * MS):
    pick = lambda df: sorted(tuple(map(repr, r)) for r in df.select(*columns).collect())
    return pick(batch) == pick(stream) and batch.count() > 3


def test_control_streams(spark, tmp_path):
    batch, stream = source(spark, tmp_path)
    before_end = F.col("ts_ns") < 10**6 * MS
    columns = ["device", "seq", "ts_ns", "kind", "q"]
    got = replay(spark, stateful.timer_ton_stream(stream, delay="2s"))
    assert same(control.timer_ton(batch).filter(before_end), got.filter(before_end), columns)
    dog = replay(spark, stateful.watchdog_stream(stream, '{"v":0}', timeout="pt", delay="2s"))
    want = control.watchdog(batch, '{"v":0}', timeout="pt")
    assert same(want.filter(before_end), dog.filter(before_end), ["device", "ts_ns", "data", "kind"])


def test_changes_and_sequences(spark, tmp_path):
    batch, stream = source(spark, tmp_path)
    inner = F.col("ts_ns") < 10**6 * MS
    got = replay(spark, stateful.changes_stream(stream, keys=("device",), value="k", epsilon=5, delay="2s"))
    want = W.changes(batch.withColumn("k", F.col("k").cast("double")), ["device"], value="k", epsilon=5)
    assert same(want.filter(inner), got.filter(inner), ["device", "seq", "k", "previous"])
    steps = ["name = 'a'", "name = 'b'"]
    got = replay(spark, stateful.sequence_match_stream(stream, steps, "150ms", delay="2s"))
    assert same(sequence.sequence_match(batch, steps, "150ms"), got, ["device", "start_ts_ns", "end_ts_ns"])


def marked(spark, folder):
    """The rows of ``source`` as a stream that the mark ends, and as a batch."""
    batch, _ = source(spark, folder)
    path = str(folder / f"in-{uuid.uuid4().hex}")
    batch.coalesce(1).write.parquet(path)
    nothing = {c: F.lit(None).cast(t) for c, t in batch.dtypes}
    end = spark.range(1).select(*[c.alias(n) for n, c in nothing.items()])
    end.withColumns({"ts_ns": F.lit(W.MARK_NS), "pt": F.lit("0s")}).write.mode("append").parquet(path)
    return batch, spark.readStream.schema(SCHEMA).parquet(path)


def test_end_of_input_settles_all(spark, tmp_path):
    batch, stream = marked(spark, tmp_path)
    for one, many in ((control.timer_ton, stateful.timer_ton_stream), (control.timer_tof, stateful.timer_tof_stream)):
        assert same(one(batch), replay(spark, many(stream)), ["device", "seq", "ts_ns", "kind", "q"])
    dog = replay(spark, stateful.watchdog_stream(stream, "f", timeout="pt"))
    assert same(control.watchdog(batch, "f", timeout="pt"), dog, ["device", "ts_ns", "data", "kind"])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("k").cast("double")).alias("sum")]
    got = replay(spark, stateful.count_window_stream(stream, 7, keys=("device",), value="k"))
    assert same(W.count_window(batch, 7, aggs, ["device"]), got, ["device", "window_no", "n", "sum", "complete"])
    assert got.filter("not complete").count() == batch.groupBy("device").count().filter("count % 7 > 0").count() > 0


def test_idle_keys_leave_no_state(spark, tmp_path):
    path = str(tmp_path / "in")
    idle = [(d, (1000 + d) * MS, d, "0", "90ms", 0, "a", "x") for d in range(1000)]
    busy = [(5000, 2000 * MS, 1, "1", "90ms", 0, "a", "x"), (5001, 10**6 * MS, 2, "0", "90ms", 0, "a", "x")]
    spark.createDataFrame(idle + busy, SCHEMA).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    stream = stateful.timer_ton_stream(spark.readStream.schema(SCHEMA).parquet(path))
    state = str(tmp_path / "state")
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", state)
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 1002
    left = lambda name: spark.read.format("statestore").option("path", state).option("stateVarName", name).load().count()
    assert left("state") == 1 and left("waiting") == 0


def test_processing_clock(spark, tmp_path):
    """Live alarms: the watchdog barks although no row arrives any more."""
    _, stream = source(spark, tmp_path)
    live = stream.filter("device = 1").withColumn("timeout", F.lit("100ms"))
    dog = stateful.watchdog_stream(live, '{"v":0}', clock="processing")
    name = f"dog_{uuid.uuid4().hex}"
    q = dog.writeStream.format("memory").queryName(name).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table(name).filter("kind = 'failsafe'").count():
                break
    finally:
        q.stop()
    kinds = {r["kind"]: r["count"] for r in spark.table(name).groupBy("kind").count().collect()}
    assert kinds["failsafe"] >= 1 and kinds["input"] >= 40


def test_stream_store_is_repeatable(spark, tmp_path):
    _, stream = source(spark, tmp_path)
    series = valid_fields(
        stream.select(
            F.lit("m").alias("measurement"), F.create_map(F.lit("d"), F.col("device").cast("string")).alias("tags"),
            F.create_map(F.lit("k"), V.integer(F.col("k"))).alias("fields"), "ts_ns",
        )
    )
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        store.stream_write_series(series, path, state).awaitTermination()
    assert store.query_series(spark, path).count() == 184


def test_rows_without_time_keep_the_first_attempts(spark, tmp_path):
    folder = str(tmp_path / "times")
    first = store.first_attempt_ns(spark, folder)
    assert first > 10**18 and store.first_attempt_ns(spark, folder) == first
    rows = spark.range(3).select(F.lit("m").alias("measurement"), F.create_map(F.lit("d"), F.lit("1")).alias("tags"),
                                 F.create_map(F.lit("k"), V.integer(F.col("id"))).alias("fields"), F.lit(0).alias("ts_ns"))
    source_ = str(tmp_path / "rows")
    rows.write.parquet(source_)
    stream = spark.readStream.schema(rows.schema).parquet(source_)
    path, state = str(tmp_path / "series"), str(tmp_path / "state0")
    store.stream_write_series(stream, path, state).awaitTermination()
    times = {r["ts_ns"] for r in store.query_series(spark, path).collect()}
    assert times == {store.first_attempt_ns(spark, f"{state}-times/0")}


class Kept:
    """State variables of one key, with a count of the calls."""

    def __init__(self):
        self.value, self.map, self.calls, self.timers = None, {}, 0, set()

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            return self._do(name, *args)

        return call

    def _do(self, name, *args):
        if name in ("getValueState", "getMapState"):
            return self
        if name == "get":
            return self.value
        if name in ("update", "clear"):
            self.value = args[0] if args else None
        elif name == "updateValue":
            self.map[args[0]] = args[1]
        elif name == "getValue":
            return self.map[args[0]]
        elif name == "removeKey":
            del self.map[args[0]]
        elif name == "registerTimer":
            self.timers.add(args[0])
        else:
            assert name == "deleteTimer", name


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_waiting_rows_take_few_state_calls():
    """Rows come out in order whatever way they arrive, in far fewer state calls than rows."""
    import random

    import pandas as pd

    n = 5000
    order = list(range(n))
    random.Random(7).shuffle(order)
    kept = Kept()
    runner = stateful.Runner(stateful.K.Changes(0.0), ["device"], ["seq", "ts_ns", "value", "previous"], True)
    runner.init(kept)
    # One row a minute or two with the same time, so that every bucket of a minute holds one or two.
    time_of = lambda i: i // 2 * 60_000 * MS
    for at in range(0, n, 900):
        some = order[at : at + 900]
        pdf = pd.DataFrame({"row_ts": [time_of(i) for i in some], "row_tie": some, "row_cells": [{"v0": float(i), "v1": i} for i in some]})
        assert list(runner.handleInputRows((1,), iter([pdf]), Clock(0))) == []
    assert min(kept.timers) == 0 and kept.calls < 100
    got = []
    for ms in (60_000 * 700, 60_000 * 701, W.END_NS // MS + 1):
        for out in runner.handleExpiredTimer((1,), Clock(ms), None):
            got += out["seq"].tolist()
        assert len(got) == min(n, 2 * (ms // 60_000 + 1))
    assert got == list(range(n)) and kept.value is None and kept.map == {} and kept.calls < 200
