from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries import EV, hot, hot_sql, query
from fixtures import captures as C
from tagflow.operators import control

_H = 3_600 * 10**9
FAILSAFE = '{"v":0}'


def inputs(ev):
    """Input true for k >= 50; delay 6 hours, sometimes none, sometimes unreadable."""
    which = F.col("event_id") % 10
    pt = F.when(which == 0, "0s").when(which == 1, "bad").otherwise("6h")
    return ev.select(
        F.col("user_id").alias("device"), F.col("event_id").alias("seq"), "ts_ns",
        F.when(F.col("k") >= 50, F.col("k").cast("string")).otherwise("false").alias("input"),
        pt.alias("pt"), F.col("k").cast("string").alias("data"),
    )


_BASE = f"""with b as (select user_id as device, event_id as seq, ts_ns, k >= 50 as inb,
  case when event_id % 10 = 0 then 0 else {6 * _H} end as pt from {EV} where event_id % 10 <> 1),
e as (select *, inb <> coalesce(lag(inb) over w, false) as edge from b window w as (partition by device order by ts_ns, seq)),
g as (select *, sum(case when edge then 1 else 0 end) over (partition by device order by ts_ns, seq) as gen from e),
h as (select g.*, x.ts_ns as edge_ts, x.pt as edge_pt, y.ts_ns as next_ts from g
  left join g x on x.device = g.device and x.gen = g.gen and x.edge
  left join g y on y.device = g.device and y.gen = g.gen + 1 and y.edge)
"""
_TON = _BASE + """
select device, seq, ts_ns, 'input' as kind, coalesce(inb and (edge_pt <= 0 or ts_ns > edge_ts + edge_pt), false) as q from h
union all
select device, seq, ts_ns + pt, 'commit', true from h where edge and inb and pt > 0 and (next_ts is null or next_ts > ts_ns + pt)"""
_TOF = _BASE + """
select device, seq, ts_ns, 'input' as kind, coalesce(inb or (edge_pt > 0 and ts_ns <= edge_ts + edge_pt), false) as q from h
union all
select device, seq, ts_ns + pt, 'commit', false from h where edge and not inb and pt > 0 and (next_ts is null or next_ts > ts_ns + pt)"""
OUT = ["device", "seq", "ts_ns", "kind", "q"]


@query("c1_timer_ton", _TON)
def c1(spark, sf):
    return control.timer_ton(inputs(C.events(spark, sf))).select(*OUT)


@query("c1_timer_ton_hot_keys", hot_sql(_TON))
def c1_hot(spark, sf):
    return control.timer_ton(inputs(hot(C.events(spark, sf)))).select(*OUT)


@query("c2_timer_tof", _TOF)
def c2(spark, sf):
    return control.timer_tof(inputs(C.events(spark, sf))).select(*OUT)


@query("c2_timer_tof_hot_keys", hot_sql(_TOF))
def c2_hot(spark, sf):
    return control.timer_tof(inputs(hot(C.events(spark, sf)))).select(*OUT)


_DOG = f"""with b as (select user_id as device, event_id as seq, ts_ns, cast(k as varchar) as data,
  case when event_id % 10 = 0 then 0 else {6 * _H} end as pt from {EV} where event_id % 10 <> 1),
n as (select *, lead(ts_ns) over (partition by device order by ts_ns, seq) as next_ts from b)
select device, seq, ts_ns, data, 'input' as kind from n
union all select device, null, ts_ns + pt, '{FAILSAFE}', 'failsafe' from n where pt > 0 and (next_ts is null or next_ts > ts_ns + pt)"""
DOG_OUT = ["device", "seq", "ts_ns", "data", "kind"]


@query("c3_watchdog", _DOG)
def c3(spark, sf):
    return control.watchdog(inputs(C.events(spark, sf)), FAILSAFE, timeout="pt").select(*DOG_OUT)


@query("c3_watchdog_hot_keys", hot_sql(_DOG))
def c3_hot(spark, sf):
    return control.watchdog(inputs(hot(C.events(spark, sf))), FAILSAFE, timeout="pt").select(*DOG_OUT)


@query(
    "c4_control_failures",
    f"select user_id as device, event_id as seq, 'invalid duration' as reason from {EV} where event_id % 10 = 1",
)
def c4(spark, sf):
    return control.control_failures(inputs(C.events(spark, sf)), "pt")[1].select("device", "seq", "reason")
