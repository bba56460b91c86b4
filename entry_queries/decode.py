from __future__ import annotations

import struct

from pyspark.sql import functions as F

from entry_queries import EV, hot, hot_sql, query
from fixtures import captures as C
from tagflow.operators import captures as P
from tagflow.operators import decode, hj212, modbus, ranges, traps


def pick(items, by):
    return F.element_at(F.array(*[F.lit(i) for i in items]), (by % len(items) + 1).cast("int"))


@query(
    "d1_decode_typed",
    f"""with t as (select event_id, k, value, event_id % 9 as w from {EV})
select event_id, case when w = 0 then (k // 4) % 2 = 1 end as flag,
 case w when 1 then k when 2 then -k when 3 then k * 600 when 4 then -k * 100000 when 5 then k * 43000000 end as whole,
 case w when 6 then k + 0.25 when 7 then value end as num, case when w = 8 then case when k % 2 = 0 then 'He' || k end end as str,
 case when w = 8 and k % 2 = 1 then '[' || k || ',' || -k || ']' end as json from t""",
)
def d1(spark, sf):
    w, k = F.col("event_id") % 9, F.col("k")
    even = k % 2 == 0
    kind = F.when((w == 8) & ~even, "INT").otherwise(
        pick(["BOOL", "BYTE", " int ", "WORD", "DINT", "DWORD", "REAL", "LREAL", "STRING"], F.col("event_id"))
    )
    form = pick(["B", "B", "h", "H", "i", "I", "f", "d", "h"], F.col("event_id"))
    number = (
        F.when(w == 2, -k).when(w == 3, k * 600).when(w == 4, -k * 100_000).when(w == 5, k * 43_000_000).otherwise(k)
    ).cast("double")
    number = F.when(w == 6, k + 0.25).when(w == 7, F.col("value")).otherwise(number)
    packed = C.pack(form, number)
    text = F.concat(F.lit("He"), k.cast("string"))
    string = F.concat(F.unhex(F.lit("FE")), F.unhex(C.hex_of(F.length(text), 1)), text.cast("binary"), F.unhex(F.lit("0000")))
    array = F.concat(packed, F.unhex(F.substring(F.hex(-k), -4, 4)))
    cell = F.when(w != 8, packed).when(even, string).otherwise(array)
    rows = C.events(spark, sf).select(
        "event_id", cell.alias("bytes"), kind.alias("type"), F.lit(2).alias("bit"),
        F.when((w == 8) & ~even, 2).otherwise(1).alias("count"),
    )
    return decode.decode_typed(rows).select(
        "event_id", F.col("value.bool").alias("flag"), F.col("value.int").cast("bigint").alias("whole"),
        F.col("value.num").alias("num"), F.col("value.str").alias("str"), F.col("value.json").alias("json"),
    )


@query(
    "d2_decode_endian",
    f"""select event_id, ['ABCD', 'CDAB', 'BADC', 'DCBA'][event_id % 4 + 1] as endian, k * 1000003 as whole,
cast(k as double) + 0.5 as num from {EV}""",
)
def d2(spark, sf):
    order = pick(["ABCD", "CDAB", "BADC", "DCBA"], F.col("event_id"))

    def reordered(hexed):
        a, b, c, d = (F.substring(hexed, i, 2) for i in (1, 3, 5, 7))
        return F.unhex(
            F.when(order == "CDAB", F.concat(c, d, a, b)).when(order == "BADC", F.concat(b, a, d, c))
            .when(order == "DCBA", F.concat(d, c, b, a)).otherwise(hexed)
        )

    rows = C.events(spark, sf).select(
        "event_id", order.alias("endian"), "k",
        reordered(C.hex_of(F.col("k") * 1_000_003, 4)).alias("word"),
        reordered(F.hex(C.pack(F.lit("f"), F.col("k") + 0.5))).alias("real"),
        F.lit("UINT32").alias("t1"), F.lit("float32").alias("t2"),
    )
    first = decode.decode_endian(rows, "word", "t1").withColumnRenamed("value", "v1")
    both = decode.decode_endian(first, "real", "t2")
    return both.select(
        "event_id", "endian", F.col("v1.int").cast("bigint").alias("whole"), F.col("value.num").alias("num")
    )


_D3 = """with recursive p as (select p_partkey % 50 as device, p_partkey as pos, (p_partkey * 7919) % 1500 as addr,
  case p_size % 4 when 0 then 1 when 1 then 2 when 2 then 8 else 300 end as width from part where p_size % 10 <> 9),
d as (select device, addr, width, min(pos) as pos from p group by 1, 2, 3),
o as (select *, row_number() over (partition by device order by addr, pos) as rn from d),
g as (select device, addr, width, rn, 0 as block, addr as first, addr + width as stop from o where rn = 1
  union all select o.device, o.addr, o.width, o.rn,
    case when o.addr > g.stop + 16 or greatest(g.stop, o.addr + o.width) - g.first > 222 then g.block + 1 else g.block end,
    case when o.addr > g.stop + 16 or greatest(g.stop, o.addr + o.width) - g.first > 222 then o.addr else g.first end,
    case when o.addr > g.stop + 16 or greatest(g.stop, o.addr + o.width) - g.first > 222 then o.addr + o.width
         else greatest(g.stop, o.addr + o.width) end
  from g join o on o.device = g.device and o.rn = g.rn + 1),
b as (select device, block, min(addr) as block_start, max(addr + width) as block_end from g group by 1, 2)
select p.pos, p.device, g.block, b.block_start, b.block_end from p join g using (device, addr, width) join b on b.device = p.device and b.block = g.block"""


def range_points(spark, sf):
    part = C.table(spark, sf, "part")
    return part.select(
        (F.col("p_partkey") % 50).alias("device"), F.lit("db").alias("area"), F.lit(1).alias("db"),
        F.col("p_partkey").alias("pos"), (F.col("p_partkey") * 7919 % 1500).cast("int").alias("addr"),
        F.when(F.col("p_size") % 10 == 9, "XYZ").otherwise(pick(["BOOL", "INT", "LREAL", "STRING"], F.col("p_size"))).alias("type"),
        F.lit(0).alias("bit"), F.lit(1).alias("count"), F.lit(298).alias("string_len"),
    )


@query("d3_coalesce_ranges", _D3)
def d3(spark, sf):
    plan, _ = ranges.coalesce_ranges(range_points(spark, sf))
    return plan.select("pos", "device", "block", "block_start", "block_end")


@query(
    "d3_rejects",
    "select p_partkey as pos, p_partkey % 50 as device, 'unsupported type' as reason from part where p_size % 10 = 9",
)
def d3_rejects(spark, sf):
    return ranges.coalesce_ranges(range_points(spark, sf))[1].select("pos", "device", "reason")


_SEG = """'QN=' || stamp || '000;ST=32;CN=' || ['2011', '2051', '2061', '2031'][event_id % 4 + 1] || ';PW=123456;MN=D' || user_id
 || ';Flag=' || k % 6 || ';CP=&&DataTime=' || stamp || ';' || case when event_id % 4 = 0 then 'a34004-Rtd=' || value || ',a34004-Flag=N;a01-ZsRtd=' || k
 else 'a34004-Avg=' || value || ',a34004-Cou=' || k || ',a34004-Flag=N' end || '&&'"""
_HJ = f"with h as (select *, strftime(make_timestamp(ts_ns // 1000), '%Y%m%d%H%M%S') as stamp from {EV})"
_FRAMES = _HJ + f""" select user_id as conn, event_id * 2 + 1 as seq, 0 as frame_no,
 '##' || lpad(cast(length({_SEG}) as varchar), 4, '0') || {_SEG} as head, length({_SEG}) + 12 as size from h"""


def heads(frames):
    text = F.decode("bytes", "ISO-8859-1")
    return frames.select(
        "conn", "seq", "frame_no", F.regexp_replace(text, r"(?s).{6}\z", "").alias("head"),
        F.length("bytes").alias("size"),
    )


def _frames(ev):
    return heads(hj212.split_frames(C.hj212_segments(ev)))


@query("f1_split_frames", _FRAMES)
def f1(spark, sf):
    return _frames(C.events(spark, sf))


@query("f1_split_frames_hot_keys", hot_sql(_FRAMES))
def f1_hot(spark, sf):
    return _frames(hot(C.events(spark, sf)))


def packed_segments(ev):
    """Segments of many frames whose first `#` came with the segment before."""
    frame = F.concat(F.lit("##0004"), F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0"), F.lit("CRCC\r\n"))
    many = F.repeat(frame, F.when(F.col("event_id") % 50 == 0, 90).otherwise(F.col("event_id") % 3 + 1).cast("int"))
    first = ev.select(F.col("user_id").alias("conn")).distinct().select(
        "conn", F.lit(-1).cast("long").alias("seq"), F.lit("noise##0000#").cast("binary").alias("bytes")
    )
    rest = ev.withColumn("_m", many).select(
        F.col("user_id").alias("conn"), F.col("event_id").alias("seq"),
        F.concat(F.expr("substring(_m, 2)"), F.lit("#")).cast("binary").alias("bytes"),
    )
    return first.unionByName(rest)


@query(
    "f1_packed_segments",
    f"""select user_id as conn, event_id as seq, frame_no::int as frame_no, '##0004' || lpad((event_id % 10000)::varchar, 4, '0') || 'CRCC' || chr(13) || chr(10) as text
from (select *, unnest(range(0, case when event_id % 50 = 0 then 90 else event_id % 3 + 1 end)) as frame_no from {EV})""",
)
def f1_packed(spark, sf):
    out = hj212.split_frames(packed_segments(C.events(spark, sf)))
    return out.select("conn", "seq", "frame_no", F.decode("bytes", "ISO-8859-1").alias("text"))


@query(
    "f1_skipped_bytes",
    f"select distinct user_id as conn, -1::bigint as seq, 'noise##0000' as text, 'bytes outside a frame' as reason from {EV}",
)
def f1_skipped(spark, sf):
    out = hj212.skipped_bytes(packed_segments(C.events(spark, sf)))
    return out.select("conn", "seq", F.decode("bytes", "ISO-8859-1").alias("text"), "reason")


@query(
    "f2_hj212_frames",
    _HJ + """ select user_id as conn, event_id as seq, stamp || '000' as qn, '32' as st, ['2011', '2051', '2061', '2031'][event_id % 4 + 1] as cn,
'123456' as pw, 'D' || user_id as mn, cast(k % 6 as varchar) as flag, ts_ns // 1000000000 * 1000000000 as ts_ns, k % 2 = 1 as needs_ack
from h where event_id % 20 <> 7""",
)
def f2(spark, sf):
    good, _ = hj212.hj212_frames(C.hj212_raw(C.events(spark, sf)))
    return good.select("conn", "seq", "qn", "st", "cn", "pw", "mn", "flag", "ts_ns", "needs_ack")


@query("f2_hj212_rejects", f"select event_id as seq, 'checksum differs' as reason from {EV} where event_id % 20 = 7")
def f2_rejects(spark, sf):
    return hj212.hj212_frames(C.hj212_raw(C.events(spark, sf)))[1].select("seq", "reason")


@query(
    "f3_hj212_points",
    f"""with h as (select * from {EV} where event_id % 20 <> 7)
select event_id as seq, pos, case when event_id % 4 = 0 then ['a34004', 'a01-Zs'][pos + 1] else ['a34004-Avg', 'a34004-Cou'][pos + 1] end as name,
 case pos when 0 then value else k end as num, ts_ns // 1000000000 * 1000000000 as ts_ns, 'D' || user_id as mn,
 strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d %H:%M:%S') as data_time from h, (select unnest([0, 1]) as pos)""",
)
def f3(spark, sf):
    good, _ = hj212.hj212_frames(C.hj212_raw(C.events(spark, sf)))
    return hj212.hj212_points(good).select(
        "seq", "pos", "name", F.col("value.num").alias("num"), "ts_ns", F.col("metadata")["mn"].alias("mn"),
        F.col("metadata")["dataTime"].alias("data_time"),
    )


@query("f3_hj212_quarantine", f"select event_id as seq from {EV} where event_id % 20 <> 7 and event_id % 9 = 0")
def f3_quarantine(spark, sf):
    """Frames with a value that no message can carry."""
    good, _ = hj212.hj212_frames(C.hj212_raw(C.events(spark, sf)))
    odd = F.concat("items", F.array(F.lit("a01-Rtd=NaN,a01-Flag=N")))
    return hj212.hj212_quarantine(good.withColumn("items", F.when(F.col("seq") % 9 == 0, odd).otherwise(F.col("items")))).select("seq")


def trap_messages(ev):
    data = F.concat(
        F.lit('{"from":"10.0.0.1:162","version":"v2c","community":"public","timestamp":'), F.col("k").cast("string"),
        F.lit(',"variables":[{"oid":".1.3.6.1.6.3.1.1.4.1.0","value":".1.3.6.1.4.1.'), F.col("user_id").cast("string"),
        F.lit('","type":"ObjectIdentifier"},{"oid":".1.3.6.2","value":"'),
        F.base64(F.concat(F.lit("link"), F.col("k").cast("string")).cast("binary")),
        F.lit('","type":"OctetString"},{"oid":"1.3.6.3","value":'), F.col("k").cast("string"), F.lit(',"type":"Integer"}]}'),
    )
    return ev.select(F.col("event_id").alias("msg_id"), F.when(F.col("event_id") % 50 == 9, "junk").otherwise(data).alias("data"))


@query(
    "f4_snmp_traps",
    f"""select event_id as msg_id, 'v2c' as version, 'public' as community, k as timestamp, '1.3.6.1.4.1.' || user_id as trap_oid,
3 as variables from {EV} where event_id % 50 <> 9""",
)
def f4(spark, sf):
    traps_, _, _ = traps.snmp_traps(trap_messages(C.events(spark, sf)))
    return traps_.select("msg_id", "version", "community", "timestamp", "trap_oid", "variables")


@query(
    "f4_trap_rejects",
    f"""select event_id as msg_id, case event_id % 4 when 0 then 'not one JSON value' when 1 then 'no list of variables'
else 'a variable is no object' end as reason from {EV} where event_id % 4 <> 3""",
)
def f4_rejects(spark, sf):
    ev = C.events(spark, sf)
    good = trap_messages(ev.filter("event_id % 50 <> 9")).join(ev.select(F.col("event_id").alias("msg_id"), "k"), "msg_id")
    which = F.col("msg_id") % 4
    none = F.concat(F.lit('{"from":"a","variables":'), F.col("k").cast("string"), F.lit("}"))
    odd = F.concat(F.lit('{"from":"a","variables":[{"oid":"1"},'), F.col("k").cast("string"), F.lit("]}"))
    rest = ev.filter("event_id % 50 = 9").select(F.col("event_id").alias("msg_id"), "k", F.lit("{}").alias("data"))
    broken = good.select("msg_id", "k", "data").unionByName(rest).withColumn(
        "data", F.when(which == 0, F.concat("data", F.lit(" junk"))).when(which == 1, none).when(which == 2, odd).otherwise(F.col("data"))
    ).filter((which != 3) | (F.col("data") != "{}"))
    return traps.snmp_traps(broken)[2].select("msg_id", "reason")


@query(
    "f4_trap_varbinds",
    f"""with t as (select event_id as msg_id, user_id, k from {EV} where event_id % 50 <> 9)
select msg_id, pos, ['1.3.6.1.6.3.1.1.4.1.0', '1.3.6.2', '1.3.6.3'][pos + 1] as oid, ['ObjectIdentifier', 'OctetString', 'Integer'][pos + 1] as type,
 case pos when 0 then '.1.3.6.1.4.1.' || user_id when 1 then 'link' || k end as text, case pos when 2 then k end as whole
from t, (select unnest([0, 1, 2]) as pos)""",
)
def f4_varbinds(spark, sf):
    _, binds, _ = traps.snmp_traps(trap_messages(C.events(spark, sf)))
    return binds.select(
        "msg_id", "pos", "oid", "type", F.coalesce(F.col("raw").cast("string"), F.col("value.str")).alias("text"),
        F.col("value.int").cast("bigint").alias("whole"),
    )


def write_events(ev):
    kind = F.when(F.col("event_id") % 3 == 0, "coil").otherwise("holding_register")
    n = (F.col("event_id") % 4).cast("int")
    values = F.transform(F.sequence(F.lit(0), n), lambda i: ((F.col("k") + i) % F.when(F.col("event_id") % 3 == 0, 2).otherwise(65536)).cast("int"))
    return ev.select(
        (F.col("user_id") % 10).alias("server"), F.col("event_id").alias("seq"), kind.alias("type"),
        (F.col("user_id") % 2 + 1).cast("int").alias("unitId"), (F.col("k") * 21).cast("int").alias("addr"),
        F.when(F.col("event_id") % 25 == 3, n + 2).otherwise(n + 1).alias("quantity"), values.alias("values"),
        F.lit("10.0.0.9").alias("clientAddr"), F.col("ts_ns").alias("timestamp"),
    )


_MB = f"""with w as (select user_id % 10 as server, event_id as seq, case when event_id % 3 = 0 then 'coil' else 'holding_register' end as type,
 k * 21 as addr, event_id % 4 + 1 + case when event_id % 25 = 3 then 1 else 0 end as quantity, event_id % 4 + 1 as have, k, ts_ns from {EV} where user_id % 2 = 0),
m as (select *, case when addr + quantity > 2000 then 'illegal data address' when have < quantity then 'illegal data value' end as reason from w),
r as (select m.*, i as pos, addr + i as address, (k + i) % case when type = 'coil' then 2 else 65536 end as value
      from m, (select unnest([0, 1, 2, 3]) as i) where reason is null and i < quantity)
"""


@query(
    "f5_modbus_writes",
    _MB + """select server, seq, type, pos, address, lpad(cast(case when type = 'coil' then 1 else 40001 end + addr as varchar), 5, '0') as modbus_addr,
value from r""",
)
def f5(spark, sf):
    rows, _ = modbus.modbus_writes(write_events(C.events(spark, sf)), unit=1)
    return rows.select("server", "seq", "type", "pos", "address", "modbus_addr", "value")


@query(
    "f5_modbus_rejects",
    _MB + f"select seq, reason from m where reason is not null union all select event_id, 'other unit' from {EV} where user_id % 2 = 1",
)
def f5_rejects(spark, sf):
    return modbus.modbus_writes(write_events(C.events(spark, sf)), unit=1)[1].select("seq", "reason")


@query(
    "f6_register_image",
    _MB + """select server, type as bank, address, arg_max(value, ts_ns * 4 + pos) as value, max(ts_ns) as written_ns from r group by 1, 2, 3""",
)
def f6(spark, sf):
    rows, _ = modbus.modbus_writes(write_events(C.events(spark, sf)), unit=1)
    return modbus.register_image(rows)


@query(
    "f6_read_range",
    _MB + """select s.server, 'holding_register' as bank, a.address, coalesce(v.value, 0) as value
from (select distinct server from r) s cross join (select unnest(range(0, 200)) as address) a
left join (select server, address, arg_max(value, ts_ns * 4 + pos) as value from r where type = 'holding_register' group by 1, 2) v
on v.server = s.server and v.address = a.address""",
)
def f6_range(spark, sf):
    rows, _ = modbus.modbus_writes(write_events(C.events(spark, sf)), unit=1)
    return modbus.read_range(modbus.register_image(rows), "holding_register", 0, 200)


def fins_captures(ev):
    w = F.col("event_id") % 20
    head = F.lit("C00002000100000200010104")
    body = F.concat(
        F.lit("82"), C.hex_of(F.col("k") * 500, 2), F.lit("30"), C.hex_of(F.col("k") % 2, 1), F.lit("B1"), C.hex_of(F.col("event_id") % 65536, 2)
    )
    text = (
        F.when(w == 1, F.concat(head, F.lit("0401")))
        .when(w == 2, F.concat(head, F.lit("0000"), F.substring("_b", 1, 14)))
        .when(w == 3, F.lit("C0000200"))
        .when(w == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(head, F.lit("0000"), F.col("_b")))
    )
    return ev.withColumn("_b", body).select(
        F.col("user_id").alias("device"), F.col("event_id").alias("seq"), F.unhex(text).alias("bytes"), F.lit(3).alias("expected")
    )


@query(
    "f7_fins_results",
    f"""select event_id as seq, pos, [130, 48, 177][pos + 1] as area, pos = 1 as is_bit,
 case pos when 0 then k * 500 when 1 then k % 2 else event_id % 65536 end as value
from {EV}, (select unnest([0, 1, 2]) as pos) where event_id % 20 not in (1, 2, 3, 4)""",
)
def f7(spark, sf):
    rows, _ = P.fins_results(fins_captures(C.events(spark, sf)))
    return rows.select("seq", "pos", "area", "is_bit", "value")


@query(
    "f7_fins_rejects",
    f"""select event_id as seq, case event_id % 20 when 1 then 'end code 0401' when 2 then 'item cut at position 2'
 when 3 then 'shorter than a response head' else 'no payload' end as reason
from {EV} where event_id % 20 in (1, 2, 3, 4)""",
)
def f7_rejects(spark, sf):
    return P.fins_results(fins_captures(C.events(spark, sf)))[1].select("seq", "reason")


def fins_answers(ev):
    """Answers to reads of three words, or of twenty bits from bit 9 on; some cut, some refused."""
    w = F.col("event_id") % 20
    bits = F.col("event_id") % 2 == 1
    head = F.concat(F.lit("C00002000100000200010101"), F.when(w == 4, "1103").otherwise("0000"))
    words = F.concat(*[C.hex_of(F.col("k") * 100 + i, 2) for i in range(3)], F.lit("FF"))
    flags = F.concat(*[C.hex_of((F.col("event_id") + i * i) % 3, 1) for i in range(20)])
    text = F.concat(head, F.when(bits, flags).otherwise(words))
    text = F.when(w == 7, F.substring(text, 1, 44)).when(w == 8, F.substring(text, 1, 38)).otherwise(text)
    return ev.select(
        F.col("user_id").alias("device"), F.col("event_id").alias("seq"), F.unhex(text).alias("bytes"),
        F.when(bits, 0x31).otherwise(0x82).alias("area"), F.lit(100).alias("address"), F.lit(9).alias("bit"),
        F.when(bits, 20).otherwise(3).alias("expected"),
    )


@query(
    "f7_fins_reads",
    f"""select event_id as seq, i as pos, 130 as area, 100 + i as address, null as bit, k * 100 + i as value
from {EV}, (select unnest([0, 1, 2]) as i) where event_id % 2 = 0 and event_id % 20 not in (4, 8)
union all select event_id, i, 49, 100 + (9 + i) // 16, (9 + i) % 16, (event_id + i * i) % 3 % 2
from {EV}, (select unnest(range(20)) as i) where event_id % 2 = 1 and event_id % 20 <> 7""",
)
def f7_reads(spark, sf):
    return P.fins_reads(fins_answers(C.events(spark, sf)))[0].drop("device")


@query(
    "f7_fins_read_rejects",
    f"""select event_id as seq, case event_id % 20 when 4 then 'end code 1103' when 7 then '8 values of 20' else '2 values of 3' end as reason
from {EV} where event_id % 20 in (4, 7, 8)""",
)
def f7_read_rejects(spark, sf):
    return P.fins_reads(fins_answers(C.events(spark, sf)))[1].select("seq", "reason")


METER = "unit int, total bigint, level double"


def meter_captures(ev):
    """Meter telegrams of nine bytes: Q, unit, total and level in little-endian order, sum of all bytes before."""
    number = lambda v, n: C.hex_of(v, n)
    turned = lambda h, n: F.concat(*[F.substring(h, 2 * i + 1, 2) for i in range(n - 1, -1, -1)])
    head = F.concat(
        F.lit("51"), number(F.col("user_id") % 256, 1), turned(number(F.col("event_id") * 37, 4), 4), turned(number(F.col("k") * 11, 2), 2)
    )
    cells = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(F.col("_h"), 2 * i + 1, F.lit(2)), 16, 10).cast("bigint"))
    off = F.when(F.col("event_id") % 30 == 4, 1).otherwise(0)
    total = F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, x: a + x) + off
    cut = F.when(F.col("event_id") % 30 == 5, 6).otherwise(9)
    return ev.withColumn("_h", head).select(
        F.col("user_id").alias("device"), F.col("event_id").alias("seq"),
        F.substring(F.unhex(F.concat("_h", number(total % 256, 1))), F.lit(1), cut).alias("bytes"),
    )


def meter_reading(telegram: bytes) -> tuple:
    """unit, total, level of one telegram."""
    form = struct.Struct("<cBIHB")
    if len(telegram) != form.size:
        raise ValueError(f"a telegram has {form.size} bytes, not {len(telegram)}")
    _, unit, total, level, stated = form.unpack(telegram)
    if sum(telegram[:-1]) % 256 != stated:
        raise ValueError("bytes do not add up")
    return unit, total, level / 1000


@query(
    "f9_decode_with",
    f"""select event_id as seq, user_id % 256 as unit, event_id * 37 as total, k * 11 / 1000 as level, null as reason from {EV}
where event_id % 30 not in (4, 5)
union all select event_id, null, null, null, case event_id % 30 when 4 then 'bytes do not add up' else 'a telegram has 9 bytes, not 6' end
from {EV} where event_id % 30 in (4, 5)""",
)
def f9(spark, sf):
    rows, rejects = decode.decode_with(meter_captures(C.events(spark, sf)), meter_reading, METER)
    return rows.drop("device").withColumn("unit", F.col("unit").cast("bigint")).withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.drop("device"), allowMissingColumns=True
    )
