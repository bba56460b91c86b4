from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries import EV, hot, hot_sql, query
from fixtures import captures as C
from tagflow.operators import hj212, sequence
from tagflow.operators import windows as W
from tagflow.plans.downsample import downsample
from tagflow.schemas import SeriesMapping

_H = 3_600 * 10**9
_GOOD = f"(select * from {EV} where event_type <> 'error')"


def good(ev):
    return W.event_time(W.numeric_points(C.points(ev)))


def good_points(spark, sf):
    return good(C.events(spark, sf))


def aggs():
    return [
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 9).alias("avg_value"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
    ]


_AGG_SQL = "count(*) as n, round(avg(value), 9) as avg_value, min(value) as min_value, max(value) as max_value"


@query(
    "w1_tumbling",
    f"select event_type as name, ts_ns // {_H} * {_H} as start_ns, {_AGG_SQL} from {_GOOD} group by 1, 2",
)
def w1(spark, sf):
    out = W.tumbling(good_points(spark, sf), "1h", aggs())
    return out.withColumn("start_ns", W.window_start_ns()).drop("window")


@query(
    "w2_sliding",
    f"""select event_type as name, (ts_ns // {2 * _H} - i) * {2 * _H} as start_ns, {_AGG_SQL}
from {_GOOD}, (select unnest([0, 1, 2]) as i) group by 1, 2""",
)
def w2(spark, sf):
    value = F.col("value")
    measures = {"n": ("count", F.lit(1)), "avg_value": ("avg", value), "min_value": ("min", value), "max_value": ("max", value)}
    out = W.sliding(good_points(spark, sf), "6h", "2h", measures)
    return out.withColumns({"start_ns": W.window_start_ns(), "avg_value": F.round("avg_value", 9)}).drop("window")


_W3 = f"""with o as (select *, case when ts_ns - lag(ts_ns) over (partition by user_id order by ts_ns) < {6 * _H} then 0 else 1 end as opens
  from {_GOOD}), s as (select *, sum(opens) over (partition by user_id order by ts_ns) as sid from o)
select user_id as device, min(ts_ns) as start_ns, max(ts_ns) + {6 * _H} as end_ns, {_AGG_SQL} from s group by user_id, sid"""


def _w3(ev):
    out = W.session(good(ev), "6h", aggs(), keys=["device"])
    return out.withColumns({"start_ns": W.window_start_ns(), "end_ns": W.window_end_ns()}).drop("window")


@query("w3_session", _W3)
def w3(spark, sf):
    return _w3(C.events(spark, sf))


@query("w3_session_hot_keys", hot_sql(_W3))
def w3_hot(spark, sf):
    return _w3(hot(C.events(spark, sf)))


_W4 = f"""with r as (select *, (row_number() over (partition by user_id order by ts_ns, event_id) - 1) // 10 as window_no from {_GOOD})
select user_id as device, window_no, cast(sum(k) as bigint) as sum_k, min(event_id) as first_id, max(event_id) as last_id,
count(*) = 10 as complete from r group by 1, 2"""


def _w4(ev):
    counts = [F.sum("k").alias("sum_k"), F.min("seq").alias("first_id"), F.max("seq").alias("last_id")]
    return W.count_window(good(ev), 10, counts, keys=["device"])


@query("w4_count_window", _W4)
def w4(spark, sf):
    return _w4(C.events(spark, sf))


@query("w4_count_window_hot_keys", hot_sql(_W4))
def w4_hot(spark, sf):
    """Three keys hold all rows."""
    return _w4(hot(C.events(spark, sf)))


@query(
    "w5_window_end_ts",
    f"select event_type as name, (ts_ns // {24 * _H} + 1) * {24 * _H} as ts_ns, count(*) as n from {_GOOD} group by 1, 2",
)
def w5(spark, sf):
    return W.window_end_ts(W.tumbling(good_points(spark, sf), "24h", [F.count(F.lit(1)).alias("n")]))


@query(
    "w6_event_time",
    f"select event_id, ts_ns // 1000 as us, ts_ns // 1000000000 * 1000000 as from_s from {EV}",
)
def w6(spark, sf):
    ev = C.events(spark, sf).withColumn("s", F.floor(F.col("ts_ns") / 1_000_000_000).cast("bigint"))
    fine = W.event_time(ev, "ts_ns", "ns").withColumnRenamed("event_time", "fine")
    both = W.event_time(fine, "s", "s")
    return both.select("event_id", F.unix_micros("fine").alias("us"), F.unix_micros("event_time").alias("from_s"))


def product():
    """Rounded twice: sums of doubles differ with the order of their rows, and a value half way between two must not follow that."""
    return F.round(F.round(F.col("view") * F.col("click"), 10), 6)


@query(
    "w7_cross_point",
    f"""select (ts_ns // {24 * _H} + 1) * {24 * _H} as ts_ns, round(avg(value) filter (event_type = 'view')
* avg(value) filter (event_type = 'click'), 6) as power from {_GOOD} where event_type in ('view', 'click') group by 1""",
)
def w7(spark, sf):
    out = W.cross_point(
        good_points(spark, sf), "24h", {"power": product()}, ["view", "click"]
    )
    return W.window_end_ts(out)


@query(
    "w8_downsample",
    f"""select user_id as device, 'points_1h' as measurement, 'a' as site, (ts_ns // {_H} + 1) * {_H} as ts_ns, event_type as field,
round(avg(value), 9) as value from {_GOOD} group by 1, 4, 5""",
)
def w8(spark, sf):
    rows = downsample(good_points(spark, sf), SeriesMapping("points_1h", (("site", "a"),)), "1h", ["device"])
    return rows.select(
        "device", "measurement", F.col("tags")["site"].alias("site"), "ts_ns", F.explode("fields").alias("field", "_v")
    ).select("device", "measurement", "site", "ts_ns", "field", F.round("_v.num", 9).alias("value"))


@query(
    "w9_transform",
    f"select event_id as seq, value * 2.0 as doubled, k + 1 as k1 from {EV} where value > 50 and event_type <> 'error'",
)
def w9(spark, sf):
    return W.transform(C.points(C.events(spark, sf)), "value > 50 and error is null", ["seq", "value * 2.0D as doubled", "k + 1 as k1"])


_W10 = f"""with l as (select *, lag(k) over (partition by user_id order by ts_ns, event_id) as previous from {EV})
select user_id as device, event_id as seq, k, previous from l where previous is null or abs(k - previous) > 20"""


def _w10(ev):
    out = W.changes(C.points(ev), ["device"], value="k", epsilon=20)
    return out.select("device", "seq", "k", "previous")


@query("w10_changes", _W10)
def w10(spark, sf):
    return _w10(C.events(spark, sf))


@query("w10_changes_hot_keys", hot_sql(_W10))
def w10_hot(spark, sf):
    return _w10(hot(C.events(spark, sf)))


_STEPS = ["name = 'view'", "name = 'click'", "name = 'purchase'"]
_W11 = f"""with recursive e as (select *, row_number() over (partition by user_id order by ts_ns, event_id) as rn from {EV}),
c as (select a.user_id, a.rn as s, a.ts_ns as start_ts_ns,
  (select min(p.rn) from e p where p.user_id = a.user_id and p.event_type = 'purchase' and p.rn >
    (select min(b.rn) from e b where b.user_id = a.user_id and b.event_type = 'click' and b.rn > a.rn)) as t
  from e a where a.event_type = 'view'),
ok as (select c.user_id, c.s, c.t, c.start_ts_ns, e.ts_ns as end_ts_ns from c join e on e.user_id = c.user_id and e.rn = c.t
  where e.ts_ns - c.start_ts_ns <= {72 * _H}),
firsts as (select user_id, min(s) as s from ok group by user_id),
m as (select o.user_id, o.s, o.t, o.start_ts_ns, o.end_ts_ns from ok o join firsts f on o.user_id = f.user_id and o.s = f.s
  union all
  select n.user_id, n.s, n.t, n.start_ts_ns, n.end_ts_ns from (
    select o.*, row_number() over (partition by o.user_id order by o.s) as pick
    from m join ok o on o.user_id = m.user_id and o.s > m.t) n where pick = 1)
select user_id as device, start_ts_ns, end_ts_ns from m"""


@query("w11_sequence_match", _W11)
def w11(spark, sf):
    return sequence.sequence_match(C.points(C.events(spark, sf)), _STEPS, "72h")


@query("w11_sequence_match_hot_keys", hot_sql(_W11))
def w11_hot(spark, sf):
    return sequence.sequence_match(C.points(hot(C.events(spark, sf))), _STEPS, "72h")


@query(
    "w12_frame_rollup",
    f"""select 'D' || user_id as mn, ['realtime', 'minute', 'hour', 'day'][event_id % 4 + 1] as grain, count(*) as frames
from {EV} where event_id % 20 <> 7 group by 1, 2""",
)
def w12(spark, sf):
    frames, _ = hj212.hj212_frames(C.hj212_raw(C.events(spark, sf)))
    return hj212.frame_rollup(frames)
