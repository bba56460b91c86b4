from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries import EV, query
from fixtures import captures as C
from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.operators import catalog, points as P
from tagflow.sources import messages as M

_MESSAGE_POINTS = f"""
with ev as {EV}, p as (
  select event_id as msg_id, 0 as pos, 'temp' as name,
         case when event_type = 'error' then null else value end as num,
         case when event_type = 'error' then 0 else ts_ns end as ts_ns,
         case when event_type = 'error' then 'i/o timeout' end as error from ev
  union all select event_id, 1, 'k', k, ts_ns + 1, null from ev
  union all select event_id, 2, 'dup', 1, 0, null from ev
  union all select event_id, 3, 'dup', event_id % 7, 0, null from ev
  union all select event_id, 4, 'bad', null, 0, 'read failed' from ev)
"""


@query("s1_read_points", _MESSAGE_POINTS + "select msg_id, pos, name, num, ts_ns, error from p")
def s1(spark, sf):
    pts = M.read_points(C.acquisition_messages(C.events(spark, sf)))
    return pts.select(
        "msg_id", "pos", "name", V.as_double(F.col("value")).alias("num"), "ts_ns", "error",
    )


@query(
    "s1_unread_points",
    f"""select event_id as msg_id, case event_id % 4 when 1 then 'wrong member type' else 'not readable as a point array' end as reason
from {EV} where event_id % 4 <> 0""",
)
def s1_unread(spark, sf):
    """Whole arrays, wrong member kinds, text behind the array, objects."""
    ev = C.events(spark, sf)
    good = F.concat(F.lit('[{"name":"p","value":'), F.col("k").cast("string"), F.lit("}]"))
    wrong = F.concat(F.lit('[{"name":"p"},{"name":'), F.col("k").cast("string"), F.lit("}]"))
    kind = F.col("event_id") % 4
    text = F.when(kind == 0, good).when(kind == 1, wrong).when(kind == 2, F.concat(good, F.lit(" x"))).otherwise(F.lit('{"name":"p"}'))
    return M.unread_points(ev.select(F.col("event_id").alias("msg_id"), text.alias("data"))).select("msg_id", "reason")


_SERIES = f"""with ev as {EV}"""


@query(
    "s2_read_series_json",
    _SERIES + """
select event_id as msg_id, 0 as pos, 'ev_' || event_type as measurement, cast(user_id as varchar) as d,
       value as v, k, ts_ns from ev where event_id % 10 not in (2, 3)""",
)
def s2(spark, sf):
    series, _ = M.read_series_json(C.series_messages(C.events(spark, sf)))
    return series.select(
        "msg_id", "pos", "measurement", F.col("tags")["d"].alias("d"),
        V.as_double(F.col("fields")["v"]).alias("v"), F.col("fields")["k"]["int"].cast("bigint").alias("k"), "ts_ns",
    )


@query(
    "s2_series_json_rejects",
    _SERIES + """
select event_id as msg_id,
       case event_id % 10 when 2 then 'no points in message' else 'not readable as series JSON' end as reason
from ev where event_id % 10 in (2, 3)""",
)
def s2_rejects(spark, sf):
    _, rejects = M.read_series_json(C.series_messages(C.events(spark, sf)))
    return rejects.select("msg_id", "reason")


@query(
    "a1_resolve_points",
    f"""with ev as {EV},
own as (select event_id as msg_id, user_id as device, 'message' as source, 0 as pos, 'dyn' as name,
               'A' || k as addr, cast(2 as double) as scale, cast(null as varchar) as error from ev where event_id % 4 = 0),
conf as (select e.event_id, e.user_id, 'catalog', i.pos, 'p' || i.pos, 'C' || e.user_id, cast(1 + i.pos as double), null
         from ev e cross join (select unnest([0, 1]) as pos) i
         where e.event_id % 4 <> 0 and e.user_id % 3 <> 0),
nothing as (select event_id, user_id, 'none', null, null, null, null,
                   'neither the message nor the catalog names a point'
            from ev where event_id % 4 <> 0 and user_id % 3 = 0)
select * from own union all select * from conf union all select * from nothing""",
)
def a1(spark, sf):
    ev = C.events(spark, sf)
    which = F.col("event_id") % 4
    asked = F.concat(F.lit('[{"name":"dyn","addr":"A'), F.col("k").cast("string"), F.lit('","scale":2}]'))
    data = F.when(which == 0, asked).when(which == 1, "[]").when(which == 2, " null ").otherwise("not-json")
    messages = ev.select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("device"), data.alias("data"))
    listed = (
        ev.filter("user_id % 3 <> 0").select(F.col("user_id").alias("device")).distinct()
        .select(
            "device", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"),
        )
        .select(
            "device", "pos", F.concat(F.lit("p"), F.col("pos").cast("string")).alias("name"),
            F.concat(F.lit("C"), F.col("device").cast("string")).alias("addr"), F.lit("INT16").alias("type"),
            (F.lit(1.0) + F.col("pos")).alias("scale"), F.lit(0.0).alias("offset"),
            F.lit("").alias("endian"), F.lit("").alias("value"),
        )
    )
    return P.resolve_points(messages, listed).select(
        "msg_id", "device", "source", "pos", "name", "addr", "scale", "error"
    )


@query(
    "a2_render_template",
    f"""select event_id, 'plant/dev-' || user_id || '/' || k || '/' || '' || '.' as topic,
'no placeholder' as fixed from {EV}""",
)
def a2(spark, sf):
    ev = C.events(spark, sf)
    meta = C.device_metadata()
    t = "plant/${metadata.deviceId}/${msg.k}/${msg.missing}."
    return ev.select(
        "event_id",
        X.render_template(t, F.col("props"), meta).alias("topic"),
        X.render_template("no placeholder", F.col("props"), meta).alias("fixed"),
    )


@query(
    "a3_render_points",
    f"""select event_id, event_type || '@dev-' || user_id as name, case when event_id % 2 = 0 then 'DB1.' || k
else 'fixed' end as addr, 'INT16' as type, '${{broken' as value, cast(2 as double) as scale from {EV}""",
)
def a3(spark, sf):
    ev = C.events(spark, sf)
    pts = ev.select(
        "event_id", "props", "user_id",
        F.concat(F.col("event_type"), F.lit("@${metadata.deviceId}")).alias("name"),
        F.when(F.col("event_id") % 2 == 0, "DB1.${msg.k}").otherwise("fixed").alias("addr"),
        F.lit("INT16").alias("type"), F.lit("").alias("endian"), F.lit("${broken").alias("value"),
        F.lit(2.0).alias("scale"),
    )
    out = P.render_points(pts, F.col("props"), C.device_metadata())
    return out.select("event_id", "name", "addr", "type", "value", "scale")


_FACTORS = """case event_type when 'view' then value when 'click' then value * 2.0 + 1.0 when 'signup' then 5.0
 when 'purchase' then value * 0.1 + 0.0 end"""


@query(
    "a4_apply_scale",
    f"select event_id as msg_id, user_id as device, event_type as name, round({_FACTORS}, 9) as num from {EV}",
)
def a4(spark, sf):
    ev = C.events(spark, sf)
    name = F.col("event_type")
    factors = (
        ev.filter(name != "error").select(F.col("user_id").alias("device"), name.alias("name")).distinct()
        .select(
            "device", "name",
            F.when(F.col("name") == "click", 2.0).when(F.col("name") == "purchase", 0.1).otherwise(0.0).alias("scale"),
            F.when(F.col("name") == "click", 1.0).when(F.col("name") == "signup", 5.0).otherwise(0.0).alias("offset"),
        )
    )
    out = P.apply_scale(C.value_points(ev), factors)
    return out.select("msg_id", "device", "name", F.round("value.num", 9).alias("num"))


@query(
    "a5_unify_quality",
    f"""select event_id as msg_id, case when event_type = 'error' then null else round(value * 0.5 + 2.0, 9) end as num,
case when event_type = 'error' then 0 else ts_ns end as ts_ns,
case when event_type = 'error' then 'read failed (quality=bad)' end as error from {EV}""",
)
def a5(spark, sf):
    ev = C.events(spark, sf).select(
        F.col("event_id").alias("msg_id"), V.num(F.col("value")).alias("value"), "ts_ns",
        F.when(F.col("event_type") == "error", "bad").otherwise("good").alias("quality"),
    )
    out = P.unify_quality(ev, F.lit(0.5), F.lit(2.0))
    return out.select("msg_id", F.round("value.num", 9).alias("num"), "ts_ns", "error")


@query(
    "a6_split_quality",
    f"""select case when event_type = 'error' then 'bad' else 'good' end as side, event_id as msg_id,
case when event_type = 'error' then 'read failed' end as error from {EV}""",
)
def a6(spark, sf):
    pts = C.value_points(C.events(spark, sf)).withColumn(
        "error", F.when(F.col("seq") % 2 == 0, F.coalesce("error", F.lit(""))).otherwise(F.col("error"))
    )
    good, bad = P.split_quality(pts)
    pick = lambda d, s: d.select(F.lit(s).alias("side"), "msg_id", "error")
    return pick(good, "good").unionByName(pick(bad, "bad"))


@query(
    "a7_batch_health",
    f"""select user_id * 1000 + ts_ns // 86400000000000 % 1000 as batch, count(*) as points,
count(*) filter (event_type = 'error') as failures,
arg_max('e' || event_id, event_id) filter (event_type = 'error') as last_error,
count(*) filter (event_type = 'error') = count(*) as all_failed from {EV} group by 1""",
)
def a7(spark, sf):
    day = F.call_function("div", F.col("ts_ns"), F.lit(86_400_000_000_000))
    pts = C.value_points(C.events(spark, sf)).withColumns(
        {
            "batch": F.col("device") * 1000 + day % 1000,
            "error": F.when(F.col("error").isNotNull(), F.concat(F.lit("e"), F.col("seq").cast("string"))),
        }
    )
    return P.batch_health(pts, ["batch"])


@query(
    "a8_classify_errors",
    f"""select user_id as device, case when event_type <> 'error' then 'good'
when k % 3 in (0, 1) then 'timeout' else 'other' end as error_class, count(*) as points from {EV} group by 1, 2""",
)
def a8(spark, sf):
    text = (
        F.when(F.col("k") % 3 == 0, "Request TIMEOUT (after 0 retries)")
        .when(F.col("k") % 3 == 1, "context deadline exceeded")
        .otherwise("connection refused")
    )
    pts = C.points(C.events(spark, sf)).withColumn("error", F.when(F.col("error").isNotNull(), text))
    return P.error_summary(pts)


_BOOL_TEXT = [" true ", "True", "1", "25.3", " 1 ", "", "false", "0", "null", "abc", "-0.0", "1.0d", "1e-3", "inf", "0x10"]
_BOOL_WANT = [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0]


@query(
    "a9_to_bool",
    f"""select event_id, [{','.join(map(str, _BOOL_WANT))}][event_id % {len(_BOOL_WANT)} + 1] = 1 as flag,
k <> 0 as k_flag from {EV}""",
)
def a9(spark, sf):
    texts = F.array(*[F.lit(t) for t in _BOOL_TEXT])
    text = F.element_at(texts, (F.col("event_id") % len(_BOOL_TEXT) + 1).cast("int"))
    return C.events(spark, sf).select(
        "event_id", X.to_bool(text).alias("flag"), X.to_bool(F.col("k").cast("string")).alias("k_flag")
    )


@query(
    "a10_duration_ms",
    f"""select event_id, case event_id % 8 when 0 then k * 1000 when 1 then k when 2 then 3600000 + k * 60000
when 3 then k * 1000 + 500 when 4 then k * 100 // 1000 when 5 then -k * 1000 when 6 then 0 end as ms from {EV}""",
)
def a10(spark, sf):
    k, which = F.col("k").cast("string"), F.col("event_id") % 8
    text = (
        F.when(which == 0, F.concat(k, F.lit("s")))
        .when(which == 1, F.concat(F.lit(" "), k, F.lit("ms")))
        .when(which == 2, F.concat(F.lit("1h"), k, F.lit("m")))
        .when(which == 3, F.concat(k, F.lit(".5s")))
        .when(which == 4, F.concat(k, F.lit("00us")))
        .when(which == 5, F.concat(F.lit("-"), k, F.lit("s")))
        .when(which == 6, "0")
        .otherwise("bad")
    )
    return C.events(spark, sf).select("event_id", X.duration_ms(text).alias("ms"))


_CATALOG = """
with c as (select p_partkey, p_size,
  case p_partkey % 3 when 0 then 's7' when 1 then 'bacnet' else 'other' end as protocol,
  case p_partkey % 7 when 0 then 'X' when 1 then 'M' else 'DB' end as area,
  case when p_size % 2 = 0 then 'BOOL' else 'INT' end as type,
  ['ai', 'ANALOG-INPUT', 'multistateValue', '17', 'nonsense'][p_partkey % 5 + 1] as object_type,
  [0, 0, 19, 17, null][p_partkey % 5 + 1] as object_code,
  case when p_size % 4 = 0 then 502 when p_size % 4 = 1 then 1000 + p_size when p_size % 4 = 2 then 502 end as port,
  case when p_size % 4 = 2 then '::1' when p_size % 4 <> 3 then 'h' || p_partkey end as host from part),
m as (select *, case
  when protocol = 's7' and area = 'X' then 'no such memory area'
  when protocol = 'bacnet' and object_code is null then 'unknown object type'
  when port is null then 'invalid port' end as reason from c)
"""


def _catalog(spark, sf):
    part = C.table(spark, sf, "part")
    key = F.col("p_partkey")
    objects = F.array(*[F.lit(x) for x in (" ai ", "ANALOG-INPUT", "multistateValue", "17", "nonsense")])
    name = F.concat(F.lit("h"), key.cast("string"))
    four = F.col("p_size") % 4
    return part.select(
        "p_partkey", "p_size",
        F.when(key % 3 == 0, "s7").when(key % 3 == 1, "bacnet").otherwise("other").alias("protocol"),
        F.when(key % 7 == 0, "x").when(key % 7 == 1, " m").otherwise("db").alias("area"),
        F.lit(1).alias("db"), F.col("p_size").alias("addr"), F.lit(3).alias("bit"),
        F.when(F.col("p_size") % 2 == 0, "bool").otherwise(" int ").alias("type"),
        F.element_at(objects, (key % 5 + 1).cast("int")).alias("object_type"),
        F.lit("pv").alias("property"),
        F.when(four == 0, name)
        .when(four == 1, F.concat(name, F.lit(":"), (F.col("p_size") + 1000).cast("string")))
        .when(four == 2, "::1")
        .otherwise("host:99999").alias("server"),
    )


@query(
    "a11_normalize_catalog",
    _CATALOG + """select p_partkey, type, case when protocol = 's7' then case when area = 'DB' then 'DB1.' || p_size
else area || p_size end || case when type = 'BOOL' then '.3' else '' end end as address,
case when protocol = 'bacnet' then object_code end as object_code, case when protocol = 'bacnet' then 85 end as property_code,
host, port from m where reason is null""",
)
def a11(spark, sf):
    good, _ = catalog.normalize_catalog(_catalog(spark, sf))
    return good.select(
        "p_partkey", F.when(F.col("type") == "BOOL", "BOOL").otherwise(F.col("type")).alias("type"), "address",
        "object_code", "property_code", "host", "port",
    )


@query("a11_catalog_rejects", _CATALOG + "select p_partkey, reason from m where reason is not null")
def a11_rejects(spark, sf):
    return catalog.normalize_catalog(_catalog(spark, sf))[1].select("p_partkey", "reason")


@query(
    "a12_validate_setpoints",
    f"""with s as (select event_id, k, event_id % 9 as w from {EV})
select event_id, case when w = 0 then k when w = 1 then k * 16 when w = 2 and k * 5 <= 255 then k * 5 when w = 3 then k
 when w = 4 then k * 1000000 when w = 7 then k end as whole,
 case when w = 6 then cast(k as double) + 0.5 end as num, case when w = 8 and k < 10 then 'text' || k end as str,
 case when w = 2 and k * 5 > 255 then 'value out of range' when w = 5 then 'unsupported type'
 when w = 8 and k >= 10 then 'text longer than its field' end as reason from s
""",
)
def a12(spark, sf):
    k, w = F.col("k"), F.col("event_id") % 9
    hexed = F.concat(F.lit("0x"), F.hex(k * 16))
    text = (
        F.when(w == 1, hexed)
        .when(w == 2, (k * 5).cast("string"))
        .when(w == 3, F.concat(k.cast("string"), F.lit("abc")))
        .when(w == 4, (k * 1_000_000).cast("string"))
        .when(w == 6, (k + 0.5).cast("string"))
        .when(w == 8, F.concat(F.lit("text"), k.cast("string")))
        .otherwise(F.concat(F.lit(" "), k.cast("string")))
    )
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ("int", "DINT", "BYTE", "integer", "UDINT", "UNKNOWN", "real", "counter64", "STRING")]),
        (w + 1).cast("int"),
    )
    protocol = F.when(w.isin(3, 7), "snmp").when(w.isin(2, 8), "s7").otherwise("eip")
    setpoints = C.events(spark, sf).select(
        "event_id", F.lit("p").alias("name"), protocol.alias("protocol"), kind.alias("type"), text.alias("value"),
        F.lit(5).alias("string_len"),
    )
    typed, rejects = catalog.validate_setpoints(setpoints)
    return typed.select(
        "event_id", F.col("typed.int").cast("bigint").alias("whole"), F.col("typed.num").alias("num"),
        F.col("typed.str").alias("str"), F.lit(None).cast("string").alias("reason"),
    ).unionByName(
        rejects.select("event_id", "reason"), allowMissingColumns=True
    )
