from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from entry_queries import EV, query
from fixtures import captures as C
from tagflow.functions import values as V
from tagflow.operators import series as S
from tagflow.schemas import SeriesMapping
from tagflow.session import ensure_checkpoint_dir
from tagflow.sources import line_protocol as L
from tagflow.sources import messages as M
from tagflow.sources import store

MAPPING = SeriesMapping("m_${metadata.deviceId}", (("d", "${metadata.deviceId}"), ("", "x")))
RENAMED = SeriesMapping("m", (), (("temp_c", "temp"), ("", "k"), ("x", "k"), ("x", "dup")))


def fields_long(df, *keep):
    """Series rows as one row per field, comparable with SQL."""
    return df.select(*keep, F.explode("fields").alias("field", "_v")).select(
        *keep, "field", V.as_double(F.col("_v")).alias("num")
    )


def with_tag(df, tag="d"):
    return df.withColumn("d", F.col("tags")[tag])


def shared_folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


_PIVOT = f"""with ev as {EV}, f as (
  select event_id as msg_id, user_id, event_type, ts_ns, 'temp' as field, value as num from ev where event_type <> 'error'
  union all select event_id, user_id, event_type, ts_ns, 'k', k from ev
  union all select event_id, user_id, event_type, ts_ns, 'dup', event_id % 7 from ev)
"""


@query(
    "b1_pivot_points",
    _PIVOT + "select msg_id, 'm' as measurement, ts_ns + 1 as ts_ns, field, num from f",
)
def b1(spark, sf):
    pts = M.read_points(C.acquisition_messages(C.events(spark, sf)))
    series, _ = S.pivot_points(pts, SeriesMapping("m"))
    return fields_long(series, "msg_id", "measurement", "ts_ns")


@query(
    "b1_passthrough",
    f"""select event_id as msg_id, p as pos, ['temp', 'k', 'dup', 'dup', 'bad'][p + 1] as name from {EV}, (select unnest(range(5)) as p)
where event_type = 'error'""",
)
def b1_passthrough(spark, sf):
    pts = M.read_points(C.acquisition_messages(C.events(spark, sf)))
    _, rest = S.pivot_points(pts, SeriesMapping("m", (), (("celsius", "temp"), ("none", "missing"), ("", "k"))))
    return rest.select("msg_id", "pos", "name")


@query(
    "b2_select_fields",
    f"""with ev as {EV}
select event_id as msg_id, ts_ns + 1 as ts_ns, 'temp_c' as field, value as num from ev where event_type <> 'error'
union all select event_id, ts_ns + 1, 'x', event_id % 7 from ev""",
)
def b2(spark, sf):
    pts = M.read_points(C.acquisition_messages(C.events(spark, sf)))
    series, _ = S.pivot_points(pts, RENAMED)
    return fields_long(series, "msg_id", "ts_ns")


_FLAT = f"""with ev as {EV}, f as (
  select event_id as msg_id, user_id, 0 as row, ts_ns, 'temperature' as field, value as num, event_id % 3 as w from ev
  union all select event_id, user_id, 0, ts_ns, 'k', k, event_id % 3 from ev
  union all select event_id, user_id, 1, null, 'k', event_id, 2 from ev where event_id % 3 = 2
  union all select event_id, user_id, 0, ts_ns, 'timestamp', null, 1 from ev where event_id % 3 = 1)
"""


@query(
    "b3_flat_to_series",
    _FLAT + """select msg_id, 'm_dev-' || user_id as measurement, row,
case when w = 1 or row = 1 then 42 else ts_ns end as ts_ns, field, num from f""",
)
def b3(spark, sf):
    out = S.flat_to_series(C.flat_messages(C.events(spark, sf)), MAPPING, default_ts=F.lit(42))
    return fields_long(out, "msg_id", "measurement", "row", "ts_ns")


@query(
    "b4_reserved_keys",
    f"""with ev as {EV}
select event_id as msg_id, 0 as row, 'stamp' as field, case when event_id % 3 <> 1 then cast(ts_ns as varchar) end as num_text,
       case when event_id % 3 = 1 then cast(ts_ns as varchar) end as str, case when event_id % 3 = 1 then 42 else ts_ns end as ts_ns
from ev
union all select event_id, 0, 'timestamp', null, cast(ts_ns as varchar), 42 from ev where event_id % 3 = 1
union all select event_id, 0, 'k', cast(k as varchar), null, case when event_id % 3 = 1 then 42 else ts_ns end from ev
union all select event_id, 1, 'k', cast(event_id as varchar), null, 42 from ev where event_id % 3 = 2""",
)
def b4(spark, sf):
    mapping = SeriesMapping("m", (), (("stamp", "timestamp"), ("timestamp", "timestamp"), ("window_id", "window_id"), ("k", "k")))
    messages = C.flat_messages(C.events(spark, sf))
    out = S.flat_to_series(messages, mapping, default_ts=F.lit(42))
    return out.select("msg_id", "row", F.explode("fields").alias("field", "_v"), "ts_ns").select(
        "msg_id", "row", "field", F.col("_v.int").cast("string").alias("num_text"), F.col("_v.str").alias("str"), "ts_ns"
    )


@query(
    "b5_dispatch_shape",
    f"""with ev as {EV}
select event_id as msg_id, case event_id % 5 when 0 then 'points' else 'flat' end as shape, ts_ns,
       'temp' as field, case event_id % 5 when 0 then value else k end as num from ev where event_id % 5 in (0, 1, 3)
union all select event_id, 'flat', ts_ns, 'name', 1 from ev where event_id % 5 = 3
union all select event_id, 'passed', null, null, null from ev where event_id % 5 in (2, 4)""",
)
def b5(spark, sf):
    mapped, passed = S.dispatch_shape(C.mixed_messages(C.events(spark, sf)), SeriesMapping("m"), F.lit(42))
    long = fields_long(mapped, "msg_id", "shape", "ts_ns")
    return long.unionByName(
        passed.select("msg_id", F.lit("passed").alias("shape")), allowMissingColumns=True
    )


@query(
    "b6_render_tags",
    f"select event_id as msg_id, 'dev-' || user_id as d, cast(k as varchar) as k, 2 as n from {EV}",
)
def b6(spark, sf):
    ev = C.events(spark, sf)
    mapping = SeriesMapping("m", (("d", "${metadata.deviceId}"), ("", "skipped"), ("k", "${msg.k}")))
    tags = S.render_tags(mapping, F.col("props"), C.device_metadata())
    return ev.select(F.col("event_id").alias("msg_id"), tags.alias("tags")).select(
        "msg_id", F.col("tags")["d"].alias("d"), F.col("tags")["k"].alias("k"), F.size("tags").alias("n")
    )


@query(
    "b7_series_to_points",
    f"""with ev as {EV} select 'ev_' || event_type as measurement, ts_ns, 'v' as name, value as num from ev
union all select 'ev_' || event_type, ts_ns, 'k', k from ev""",
)
def b7(spark, sf):
    out = S.series_to_points(C.series(C.events(spark, sf)))
    return out.select("measurement", "ts_ns", "name", V.as_double(F.col("value")).alias("num"))


@query(
    "b8_points_to_columns",
    f"""select event_id as msg_id, case when event_type <> 'error' then value end as temp,
cast(k as double) as k, cast(event_id % 7 as double) as dup from {EV}""",
)
def b8(spark, sf):
    pts = M.read_points(C.acquisition_messages(C.events(spark, sf)))
    return S.points_to_columns(pts, ["temp", "k", "dup"])


@query(
    "b9_valid_fields",
    f"""select event_id as msg_id, 'v' as field, value as num from {EV} where event_id % 5 not in (0, 1, 2)
union all select event_id, 'k', k from {EV} where event_id % 5 <> 3""",
)
def b9(spark, sf):
    which = F.col("event_id") % 5
    v = (
        F.when(which == 0, F.lit(float("nan")))
        .when(which == 1, F.lit(float("-inf")))
        .when(which == 2, F.lit(None).cast("double"))
        .otherwise(F.col("value"))
    )
    k = F.when(which != 3, F.col("k"))
    rows = C.events(spark, sf).select(
        F.col("event_id").alias("msg_id"), F.create_map(F.lit("v"), V.num(v), F.lit("k"), V.integer(k)).alias("fields")
    )
    return fields_long(S.valid_fields(rows), "msg_id")


_LINE_TEXT = "'ev_' || event_type || ',d=' || user_id || ' k=' || k || 'i,v=' || value || ' ' || ts_ns"


@query(
    "s3_rejects",
    f"""select case event_id % 5 when 0 then 'k' || k when 1 then 'm v=' || k || 'x' when 2 then 'm v=1i 9' || event_id || repeat('0', 20)
 else 'm,d= v=' || k end as line,
 case event_id % 5 when 1 then 'invalid field value' when 2 then 'timestamp out of range' else 'invalid line format' end as reason
from {EV} where event_id % 5 < 4""",
)
def s3_rejects(spark, sf):
    k, number = F.col("k").cast("string"), F.col("event_id").cast("string")
    which = F.col("event_id") % 5
    line = (
        F.when(which == 0, F.concat(F.lit("k"), k)).when(which == 1, F.concat(F.lit("m v="), k, F.lit("x")))
        .when(which == 2, F.concat(F.lit("m v=1i 9"), number, F.lit("0" * 20))).when(which == 3, F.concat(F.lit("m,d= v="), k))
        .otherwise(F.concat(F.lit("m v="), k))
    )
    return L.read_line_protocol(C.events(spark, sf).select(line.alias("value")))[1].select("line", "reason")


@query(
    "s3_read_line_protocol",
    f"""with ev as {EV}, f as (
  select ts_ns, event_id, user_id, event_type, 'v' as field, value as num, null as str from ev
  union all select ts_ns, event_id, user_id, event_type, 'k', k, null from ev
  union all select ts_ns, event_id, user_id, event_type, 'note', null, 'a "' || k || '", b' from ev)
select 'ev ' || event_type as measurement, 'u,' || user_id as d, ts_ns, field, num, str from f
where event_id % 10 not in (3, 4)""",
)
def s3(spark, sf):
    ev = C.events(spark, sf)
    which = F.col("event_id") % 10
    line = F.concat(
        F.lit("ev\\ "), F.col("event_type"), F.lit(",d=u\\,"), F.col("user_id").cast("string"), F.lit(" v="),
        F.col("value").cast("string"), F.lit(",k="), F.col("k").cast("string"), F.lit('i,note="a \\"'),
        F.col("k").cast("string"), F.lit('\\", b" '), F.col("ts_ns").cast("string"),
    )
    text = F.when(which == 3, "# comment").when(which == 4, F.concat(F.lit("broken v="), F.col("k").cast("string"), F.lit("x"))).otherwise(line)
    series, _ = L.read_line_protocol(ev.select(text.alias("value")))
    long = series.select("measurement", F.col("tags")["d"].alias("d"), "ts_ns", F.explode("fields").alias("field", "_v"))
    return long.select(
        "measurement", "d", "ts_ns", "field", V.as_double(F.col("_v")).alias("num"), F.col("_v.str").alias("str")
    )


@query(
    "s3_values_over_lines",
    f"""select 'ev' as measurement, cast(user_id as varchar) as d, ts_ns,
 case event_id % 3 when 0 then 'first ' || k || chr(10) || '# two' || chr(10) || chr(10) || 'ev,d=1 v=1i 5 "x", ' || k else 'one ' || k end as note, null as reason
 from {EV} where event_id % 10 <> 4
union all select null, null, null, 'ev,d=' || user_id || ' note="open ' || k, 'invalid line format' from {EV} where event_id % 10 = 4""",
)
def s3_values_over_lines(spark, sf):
    """Files with values of several lines, among lines that open a value and never close it."""
    k, user = F.col("k").cast("string"), F.col("user_id").cast("string")
    long_note = F.concat(F.lit("first "), k, F.lit('\n# two\n\nev,d=1 v=1i 5 \\"x\\", '), k)
    note = F.when(F.col("event_id") % 3 == 0, long_note).otherwise(F.concat(F.lit("one "), k))
    whole = F.concat(F.lit("ev,d="), user, F.lit(' note="'), note, F.lit('" '), F.col("ts_ns").cast("string"))
    broken = F.concat(F.lit("ev,d="), user, F.lit(' note="open '), k)
    path = shared_folder(spark, "lines")
    C.events(spark, sf).select(F.when(F.col("event_id") % 10 == 4, broken).otherwise(whole).alias("value")).write.text(path)
    series, rejects = L.read_line_protocol(path, spark)
    read = series.select("measurement", F.col("tags")["d"].alias("d"), "ts_ns", F.col("fields")["note"]["str"].alias("note"))
    return read.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.select(F.col("line").alias("note"), "reason"), allowMissingColumns=True
    )


@query("s5_write_line_protocol", f"select {_LINE_TEXT} as line from {EV}")
def s5(spark, sf):
    """Lines written to text files and read back as text."""
    path = shared_folder(spark, "lines")
    L.write_line_protocol(C.series(C.events(spark, sf)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "s4_write_series",
    f"""select 'ev_' || event_type as measurement, cast(user_id as varchar) as d, ts_ns, f as field,
case f when 'v' then value else k end as num from {EV}, (select unnest(['v', 'k']) as f)""",
)
def s4(spark, sf):
    path = shared_folder(spark, "series")
    store.write_series(C.series(C.events(spark, sf)), path)
    return fields_long(with_tag(store.query_series(spark, path)), "measurement", "d", "ts_ns")


_DAY0 = 1704067200 * 10**9
_DAY = 86400 * 10**9


@query(
    "s6_query_series",
    f"""select 'ev_view' as measurement, ts_ns, value as v from {EV} where event_type = 'view'
and ts_ns >= {_DAY0 + 3 * _DAY + 5} and ts_ns < {_DAY0 + 9 * _DAY + 7}""",
)
def s6(spark, sf):
    path = shared_folder(spark, "series")
    store.write_series(C.series(C.events(spark, sf)), path)
    out = store.query_series(
        spark, path, "ev_view", fields=["v"], start_ns=_DAY0 + 3 * _DAY + 5, end_ns=_DAY0 + 9 * _DAY + 7
    )
    return out.select("measurement", "ts_ns", F.col("v.num").alias("v"))


@query(
    "s6_query_series_by_tag",
    f"""select 'ev_' || event_type as measurement, cast(user_id as varchar) as d, ts_ns, value as v, false as one_series from {EV} where user_id = 7
union all select 'ev_view', '11', ts_ns, value, true from {EV} where user_id = 11 and event_type = 'view'""",
)
def s6_by_tag(spark, sf):
    """All series of one tag value, and one whole series."""
    path, layout = shared_folder(spark, "series"), store.Layout(("d",))
    store.write_series(C.series(C.events(spark, sf)), path, layout=layout)
    tagged = store.query_series(spark, path, tags={"d": "7"}, fields=["v"], layout=layout)
    one = store.query_series(spark, path, "ev_view", {"d": "11"}, ["v"], layout=layout, whole_tags=True)
    rows = tagged.withColumn("one_series", F.lit(False)).unionByName(one.withColumn("one_series", F.lit(True)))
    return rows.select("measurement", F.col("tags")["d"].alias("d"), "ts_ns", F.col("v.num").alias("v"), "one_series")


@query(
    "s6_query_series_sql",
    f"select 'ev_' || event_type as measurement, count(*) as rows, max(ts_ns) as newest from {EV} group by 1",
)
def s6_sql(spark, sf):
    path = shared_folder(spark, "series")
    store.write_series(C.series(C.events(spark, sf)), path)
    view = f"series_{uuid.uuid4().hex}"
    return store.query_series(
        spark, path, view=view,
        sql=f"select measurement, count(*) as rows, max(ts_ns) as newest from {view} group by measurement",
    )


@query(
    "s7_latest_series",
    f"""select cast(user_id as varchar) as d, max(ts_ns) as ts_ns, arg_max('ev_' || event_type, ts_ns) as measurement,
arg_max(value, ts_ns) as v from {EV} group by 1""",
)
def s7(spark, sf):
    rows = C.series(C.events(spark, sf))
    out = store.latest_series(rows, [F.col("tags")["d"]])
    return out.select(F.col("tags")["d"].alias("d"), "ts_ns", "measurement", F.col("fields")["v"]["num"].alias("v"))


