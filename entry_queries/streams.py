"""Streaming forms, replayed to the end of the table and read back.

The mark that ends the input settles everything, so each query has the SQL of its
batch form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries import EV, query
from entry_queries import control as CQ
from entry_queries import decode as DQ
from entry_queries import windows as WQ
from entry_queries.series import fields_long, shared_folder, with_tag
from fixtures import captures as C
from tagflow.operators import windows as W
from tagflow.sources import commits, store
from tagflow.streaming import stateful

_H = 3_600 * 10**9
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay(spark, stream):
    """Run a stream over everything that is there and return what it wrote."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    out = shared_folder(spark, "stream-out")
    q = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", shared_folder(spark, "stream-state"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def ending(spark, sf):
    return C.stream_events(spark, sf, shared_folder(spark, "stream-end"))


def good_stream(spark, sf):
    return W.event_time(W.numeric_points(C.points(ending(spark, sf))), watermark="1ms")


@query(
    "s8_stream_write_series",
    f"""select 'ev_' || event_type as measurement, cast(user_id as varchar) as d, ts_ns, f as field,
case f when 'v' then value else k end as num from {EV}, (select unnest(['v', 'k']) as f)""",
)
def s8(spark, sf):
    path = shared_folder(spark, "series-stream")
    q = store.stream_write_series(
        C.series(C.stream_events(spark, sf)), path, shared_folder(spark, "stream-state")
    )
    q.awaitTermination()
    return fields_long(with_tag(store.query_series(spark, path)), "measurement", "d", "ts_ns")


@query(
    "s8_compacted_batches",
    f"""select 'ev_' || event_type as measurement, cast(user_id as varchar) as d, ts_ns, f as field,
case f when 'v' then value else k end as num, 1 as folders from {EV}, (select unnest(['v', 'k']) as f)""",
)
def s8_compacted(spark, sf):
    """Two batches, one of them run twice, merged into one folder."""
    path = shared_folder(spark, "series-batches")
    events = C.events(spark, sf)
    for batch in (0, 1, 1):
        store.write_batch(C.series(events.filter(F.col("event_id") % 2 == batch)), path, batch, F.lit(1))
    store.compact_batches(spark, path, fan_in=2)
    commits.vacuum(spark, path)
    out = fields_long(with_tag(store.query_series(spark, path)), "measurement", "d", "ts_ns")
    return out.withColumn("folders", F.lit(len(commits.entries(spark, path))))


@query(
    "w1_tumbling_stream",
    f"select event_type as name, (ts_ns // {_H} + 1) * {_H} as end_ns, {WQ._AGG_SQL} from {WQ._GOOD} group by 1, 2",
)
def w1_stream(spark, sf):
    out = W.tumbling(good_stream(spark, sf), "1h", WQ.aggs())
    return replay(spark, out.withColumn("end_ns", W.window_end_ns()).drop("window"))


@query(
    "w2_sliding_stream",
    f"""select event_type as name, (ts_ns // {2 * _H} - i) * {2 * _H} + {6 * _H} as end_ns, {WQ._AGG_SQL}
from {WQ._GOOD}, (select unnest([0, 1, 2]) as i) group by 1, 2""",
)
def w2_stream(spark, sf):
    out = W.sliding_stream(good_stream(spark, sf), "6h", "2h", WQ.aggs())
    return replay(spark, out.withColumn("end_ns", W.window_end_ns()).drop("window"))


@query(
    "w3_session_stream",
    f"""with o as (select *, case when ts_ns - lag(ts_ns) over (partition by user_id order by ts_ns) < {6 * _H} then 0 else 1 end as opens
  from {WQ._GOOD}), s as (select *, sum(opens) over (partition by user_id order by ts_ns) as sid from o)
select user_id as device, min(ts_ns) as start_ns, max(ts_ns) + {6 * _H} as end_ns, {WQ._AGG_SQL} from s group by user_id, sid""",
)
def w3_stream(spark, sf):
    out = W.session_stream(good_stream(spark, sf), "6h", WQ.aggs(), keys=["device"])
    return replay(spark, out.withColumns({"start_ns": W.window_start_ns(), "end_ns": W.window_end_ns()}).drop("window"))


@query(
    "w7_cross_point_stream",
    f"""select (ts_ns // {24 * _H} + 1) * {24 * _H} as ts_ns, round(avg(value) filter (event_type = 'view')
* avg(value) filter (event_type = 'click'), 6) as power from {WQ._GOOD} where event_type in ('view', 'click') group by 1""",
)
def w7_stream(spark, sf):
    out = W.cross_point(
        good_stream(spark, sf), "24h", {"power": F.round(F.col("view") * F.col("click"), 6)}, ["view", "click"]
    )
    return replay(spark, W.window_end_ts(out))


@query(
    "w4_count_window_stream",
    f"""with r as (select *, (row_number() over (partition by user_id order by ts_ns, event_id) - 1) // 10 as window_no from {EV})
select user_id as device, window_no, min(ts_ns) as start_ns, max(ts_ns) as end_ns, count(*) as n, cast(sum(k) as double) as sum,
 cast(sum(k) as double) / count(*) as avg, cast(min(k) as double) as min, cast(max(k) as double) as max, count(*) = 10 as complete
from r group by 1, 2""",
)
def w4_stream(spark, sf):
    return replay(spark, stateful.count_window_stream(C.points(ending(spark, sf)), 10, keys=("device",), value="k"))


@query(
    "w10_changes_stream",
    f"""select device, seq, cast(k as double) as k, cast(previous as double) as previous from ({WQ._W10})""",
)
def w10_stream(spark, sf):
    out = stateful.changes_stream(C.points(ending(spark, sf)), keys=("device",), value="k", epsilon=20)
    return replay(spark, out.drop("ts_ns"))


@query("w11_sequence_match_stream", WQ._W11)
def w11_stream(spark, sf):
    return replay(spark, stateful.sequence_match_stream(C.points(ending(spark, sf)), WQ._STEPS, "72h"))


@query("c1_timer_ton_stream", CQ._TON)
def c1_stream(spark, sf):
    return replay(spark, stateful.timer_ton_stream(CQ.inputs(ending(spark, sf)))).select(*CQ.OUT)


@query("c2_timer_tof_stream", CQ._TOF)
def c2_stream(spark, sf):
    return replay(spark, stateful.timer_tof_stream(CQ.inputs(ending(spark, sf)))).select(*CQ.OUT)


@query("c3_watchdog_stream", CQ._DOG)
def c3_stream(spark, sf):
    out = stateful.watchdog_stream(CQ.inputs(ending(spark, sf)), CQ.FAILSAFE, timeout="pt")
    return replay(spark, out).select(*CQ.DOG_OUT)


@query("f1_split_frames_stream", DQ._FRAMES)
def f1_stream(spark, sf):
    segments = C.hj212_segments(ending(spark, sf), keep_time=True)
    return DQ.heads(replay(spark, stateful.split_frames_stream(segments)))
