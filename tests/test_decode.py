from __future__ import annotations

import math
import random
import struct

import pandas as pd
from pyspark.sql import functions as F

from helpers import plain
from tagflow.functions import bytecodec
from tagflow.operators import captures, catalog, decode, hj212, modbus, ranges, traps

SEG = (
    "QN=20170818122101000;ST=32;CN=2011;PW=123456;MN=DEVICE001;Flag=5;CP=&&DataTime=20170818122101;"
    "a34004-Rtd=2.3,a34004-Flag=N;a34002-Rtd=167.5,a34002-Flag=N;B01-Rtd=1.28&&"
)


def frame(seg, crc=None, length=None, end=b"\r\n"):
    body = seg.encode()
    value = int(bytecodec.crc16(pd.Series([body]))[0]) if crc is None else crc
    return b"##%04d%s%04X" % (len(body) if length is None else length, body, value) + end


def frames(spark, *raw, zone="UTC"):
    df = spark.createDataFrame([("c", i, 0, r) for i, r in enumerate(raw)], "conn string, seq long, frame_no int, bytes binary")
    good, bad = hj212.hj212_frames(df, zone=zone)
    return good, {r["seq"]: r["reason"] for r in bad.collect()}


def test_crc_vector():
    assert bytecodec.crc16(pd.Series([b"123456789", b"", b"1"])).tolist()[:2] == [0x4B37, 0xFFFF]


def test_real_time_frame(spark):
    good, bad = frames(spark, frame(SEG), frame(SEG, end=b""))
    assert bad == {}
    row = good.orderBy("seq").first()
    assert (row["st"], row["cn"], row["mn"], row["qn"], row["flag"], row["needs_ack"]) == ("32", "2011", "DEVICE001", "20170818122101000", "5", True)
    pts = hj212.hj212_points(good.filter("seq = 0")).orderBy("pos").collect()
    assert [(p["name"], plain(p["value"]), p["ts_ns"]) for p in pts] == [
        ("a34004", 2.3, 1503058861 * 10**9), ("a34002", 167.5, 1503058861 * 10**9), ("B01", 1.28, 1503058861 * 10**9)
    ]
    assert pts[0]["metadata"] == {"mn": "DEVICE001", "st": "32", "cn": "2011", "dataTime": "2017-08-18 12:21:01"}
    shifted, _ = frames(spark, frame(SEG), zone="Asia/Shanghai")
    assert shifted.first()["ts_ns"] == (1503058861 - 8 * 3600) * 10**9


def test_statistic_names(spark):
    seg = (
        "QN=1;ST=32;CN=2051;PW=1;MN=D;Flag=4;CP=&&DataTime=20170818122000;a34004-Avg=2.1,a34004-Min=1.8,a34004-Max=2.5,"
        "a34004-Cou=10.5,a34004-Flag=N;a01-ZsRtd=3,a01-ZsAvg=4,a01-Rtd=x,a01-SampleTime=1&&"
    )
    good, _ = frames(spark, frame(seg))
    names = [p["name"] for p in hj212.hj212_points(good).orderBy("pos").collect()]
    assert names == ["a34004-Avg", "a34004-Min", "a34004-Max", "a34004-Cou", "a01-Zs", "a01-ZsAvg"]
    assert good.first()["needs_ack"] is False


def test_faulty_frames(spark):
    no_time = SEG.replace("DataTime=20170818122101;", "")
    good, bad = frames(
        spark, frame(no_time), frame(SEG, crc=1), frame("QN=1;ST=32;"), frame(SEG, length=9999), b"ST=32;CN=2011;CP=&&&&\r\n",
        frame("QN=1;CP=&&"), frame(SEG)[:-6] + b"ZZZZ\r\n", b"##abcd" + frame(SEG)[6:], frame(SEG.replace("2.3", "NaN")),
    )
    assert bad == {
        1: "checksum differs", 2: "no data part", 3: "length field and size differ", 4: "does not begin as a frame",
        5: "data part is not closed", 6: "checksum is no hexadecimal number", 7: "length field is no number",
    }
    assert {r["seq"]: r["ts_ns"] for r in good.collect()}[0] == 0
    assert {r["seq"] for r in hj212.hj212_points(good).collect()} == {0}
    assert [r["seq"] for r in hj212.hj212_quarantine(good).collect()] == [8]


def test_feed():
    f = frame(SEG)
    assert hj212.feed(b"", b"garbage##noise" + f) == (b"", [(f, None), (b"garbage##noise", hj212.NOISE)][::-1])
    assert hj212.feed(b"", f + f) == (b"", [(f, None), (f, None)])
    rest, got = hj212.feed(b"", f[:10])
    assert (rest, got) == (f[:10], []) and hj212.feed(rest, f[10:]) == (b"", [(f, None)])
    assert hj212.feed(b"", f + b"#") == (b"#", [(f, None)]) and hj212.feed(b"#", f[1:]) == (b"", [(f, None)])
    big = b"##2000" + b"x" * 2000 + b"ABCD\r\n"
    rest, got = hj212.feed(b"", big[:2011])
    assert got == [] and hj212.feed(rest, big[2011:] + f * 12) == (b"", [(big, None)] + [(f, None)] * 12)
    assert hj212.feed(b"", b"##-012##0000##1") == (b"##1", [(b"##-012##0000", hj212.NOISE)])


def typed(spark, *cases):
    df = spark.createDataFrame(
        [(i, bytes.fromhex(h), t, b, c) for i, (h, t, b, c) in enumerate(cases)], "i int, bytes binary, type string, bit int, count int"
    )
    return [plain(r["value"]) for r in decode.decode_typed(df).orderBy("i").collect()]


def test_typed_values(spark):
    real, lreal = struct.pack(">f", 23.5).hex(), struct.pack(">d", -1.25).hex()
    assert typed(
        spark, ("04", "BOOL", 2, 1), ("04", "bool", 9, 1), ("ff", "BYTE", 0, 1), ("ffff", "INT", 0, 1), ("0100", "WORD", 0, 1),
        ("fffffffe", "DINT", 0, 1), ("ffffffff", "DWORD", 0, 1), (real, "REAL", 0, 1), (lreal, "LREAL", 0, 1),
        ("fe0548656c6c6f0000", "STRING", 0, 1), ("fe0a4869", "STRING", 0, 1), ("ff", "INT", 0, 1), ("", "BOOL", 0, 1),
        ("00010002ff", "INT", 0, 3), ("09", "BOOL", 3, 4), ("00", "NOPE", 0, 1),
    ) == [True, False, 255, -1, 256, -2, 4294967295, 23.5, -1.25, "Hello", "Hi", 0, False, "[1,2]", True, None]


def test_numbers_bit_by_bit(spark):
    """Infinities, NaN, subnormals, zeros of both signs, borders of every width; cells cut short are marked."""
    rng = random.Random(2)
    reals = [0.0, -0.0, 1.0, -2.5, 1e-45, 1.1754942e-38, 3.4028235e38, float("inf"), float("-inf"), float("nan")]
    reals32 = [struct.pack(">f", x) for x in reals] + [rng.randbytes(4) for _ in range(60)]
    reals64 = [struct.pack(">d", x) for x in [*reals, 5e-324, 2.2250738585072009e-308, 1.7976931348623157e308]] + [rng.randbytes(8) for _ in range(60)]
    cases = [("REAL", b, struct.unpack(">f", b)[0]) for b in reals32] + [("LREAL", b, struct.unpack(">d", b)[0]) for b in reals64]
    for kind, form in (("BYTE", ">B"), ("INT", ">h"), ("WORD", ">H"), ("DINT", ">i"), ("DWORD", ">I")):
        n = struct.calcsize(form)
        cells = [bytes(n), b"\xff" * n, b"\x7f" + b"\xff" * (n - 1), b"\x80" + bytes(n - 1), *(rng.randbytes(n + 2) for _ in range(9))]
        cases += [(kind, b, struct.unpack(form, b[:n])[0]) for b in cells]
    df = spark.createDataFrame([(i, k, b) for i, (k, b, _) in enumerate(cases)], "i int, type string, bytes binary")
    out = decode.decode_typed(df)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r, (_, _, want) in zip(out.orderBy("i").collect(), cases):
        got = plain(r["value"])
        assert not r["short"] and (math.isnan(got) if want != want else got == want and math.copysign(1, float(got)) == math.copysign(1, want))
    words = [("INT64", ">q"), ("UINT64", ">Q"), ("FLOAT64", ">d"), ("UINT16", ">H"), ("INT32", ">i")]
    rows = [(i, k, rng.randbytes(struct.calcsize(f)), f) for i, (k, f) in enumerate(words * 20)]
    swap = {"ABCD": lambda b: b, "DCBA": lambda b: b[::-1], "BADC": lambda b: b"".join(b[i : i + 2][::-1] for i in range(0, len(b), 2)),
            "CDAB": lambda b: b"".join(b[i : i + 2] for i in range(len(b) - 2, -1, -2))}
    df = spark.createDataFrame([(i * 4 + j, o.lower(), k, swap[o](b)) for i, k, b, _ in rows for j, o in enumerate(swap)], "i int, endian string, type string, bytes binary")
    got = [plain(r["value"]) for r in decode.decode_endian(df).orderBy("i").collect()]
    want = [struct.unpack(f, b)[0] for _, _, b, f in rows for _ in swap]
    assert all(math.isnan(g) if w != w else g == w for g, w in zip(got, want)) and len(got) == len(want)
    cut = [("INT", b"\x01"), ("LREAL", bytes(7)), ("BOOL", b""), ("STRING", b"\xfe\x05Hi"), ("INT", b"\0\1"), ("STRING", b"\xfe\2Hi"), ("NOPE", b""), ("DINT", None)]
    df = spark.createDataFrame([(i, k, b) for i, (k, b) in enumerate(cut)], "i int, type string, bytes binary")
    assert [r["short"] for r in decode.decode_typed(df).orderBy("i").collect()] == [True] * 4 + [False] * 4


def test_word_orders(spark):
    df = spark.createDataFrame(
        [(0, "ABCD", "41bc0000"), (1, "CDAB", "000041bc"), (2, "BADC", "bc410000"), (3, "DCBA", "0000bc41"), (4, "XXXX", "41bc0000"), (5, "", "41bc")],
        "i int, endian string, h string",
    ).select("i", "endian", F.unhex("h").alias("bytes"), F.lit("FLOAT32").alias("type"))
    assert [plain(r["value"]) for r in decode.decode_endian(df).orderBy("i").collect()] == [23.5] * 4 + [None, None]


def test_ranges(spark):
    def blocks(starts, widths, pdu):
        rows = [("d", "DB", 1, a, "STRING", 0, 1, w - 2, i) for i, (a, w) in enumerate(zip(starts, widths))]
        cols = "device string, area string, db int, addr int, type string, bit int, count int, string_len int, pos int"
        plan, _ = ranges.coalesce_ranges(spark.createDataFrame(rows, cols), pdu=pdu)
        return [r["block"] for r in plan.orderBy("pos").collect()]

    assert blocks([0, 3, 6], [3, 3, 4], 240) == [0, 0, 0]
    assert blocks([0, 19, 39], [3, 3, 3], 240) == [0, 0, 1]
    assert max(blocks([3 * i for i in range(60)], [3] * 60, 68)) == 3
    assert blocks([0, 4, 270, 10], [3, 250, 3, 3], 240) == [0, 1, 3, 2]
    assert (ranges.payload_budget(), ranges.payload_budget(10), ranges.payload_budget(480)) == (222, 1, 462)


def test_range_plan(spark):
    cols = "device string, area string, db int, addr int, type string, bit int, count int, string_len int, name string, pos int"
    rows = [("d", "db", 1, 0, "INT", 0, 1, 0, "a", 0), ("d", "DB", 1, 2, "REAL", 0, 1, 0, "b", 1), ("d", "DB", 2, 2, "REAL", 0, 1, 0, "c", 2),
            ("d", "M", 7, 0, "BOOL", 0, 1, 0, "m", 3), ("d", "M", 8, 0, "BOOL", 3, 1, 0, "n", 4), ("d", "X", 1, 0, "INT", 0, 1, 0, "x", 5), ("d", "DB", 1, 0, "?", 0, 1, 0, "y", 6)]
    plan, bad = ranges.coalesce_ranges(spark.createDataFrame(rows, cols))
    got = {r["name"]: (r["block"], r["block_start"], r["block_end"]) for r in plan.collect()}
    assert got == {"a": (0, 0, 6), "b": (0, 0, 6), "c": (0, 2, 6), "m": (0, 0, 1), "n": (0, 0, 1)}
    assert {r["name"]: r["reason"] for r in bad.collect()} == {"x": "no such memory area", "y": "unsupported type"}


def fins(spark, *cases):
    df = spark.createDataFrame([("d", i, bytes.fromhex(h), n) for i, (h, n) in enumerate(cases)], "device string, seq long, bytes binary, expected int")
    rows, bad = captures.fins_results(df)
    items = {}
    for r in rows.orderBy("seq", "pos").collect():
        items.setdefault(r["seq"], []).append((r["value"], r["is_bit"]))
    return items, {r["seq"]: r["reason"] for r in bad.collect()}


def test_fins(spark):
    head = "c0000200000000000001" + "0104"
    items, bad = fins(
        spark, (head + "0000" + "8212348256783001b1abcd", 4), (head + "0401", 1), ("c000", 1), (head + "0000" + "82123482", 2), (head + "0000" + "821234", 2)
    )
    assert items == {0: [(0x1234, False), (0x5678, False), (1, True), (0xABCD, False)]}
    assert bad == {1: "end code 0401", 2: "shorter than a response head", 3: "item cut at position 1", 4: "no item at position 1"}


def test_fins_single_reads(spark):
    head = bytes.fromhex("c00002000000000000010101")
    rows = [
        (1, head + b"\0\0" + bytes.fromhex("00ff8001"), 0x82, 30, None, 2), (2, head + b"\0\0" + b"\1\0\3\2", 0x30, 7, 14, 4),
        (3, head + b"\0\0\0", 0x82, 30, None, 1), (4, head + b"\x21\x02", 0x82, 0, 0, 1), (5, head, 0x82, 0, 0, 1),
        (6, None, 0x82, 0, 0, 1), (7, head + b"\0\0\7", 0x82, 0, 0, 0), (8, head + b"\0\0\1", 0x32, 0, None, None),
    ]
    df = spark.createDataFrame([("d", *r) for r in rows], "device string, seq long, bytes binary, area int, address int, bit int, expected int")
    values, bad = captures.fins_reads(df)
    got = [(r["seq"], r["address"], r["bit"], r["value"]) for r in values.orderBy("seq", "pos").collect()]
    assert got == [(1, 30, None, 255), (1, 31, None, 0x8001), (2, 7, 14, 1), (2, 7, 15, 0), (2, 8, 0, 1), (2, 8, 1, 0)]
    assert {r["seq"]: r["reason"] for r in bad.collect()} == {
        3: "0 values of 1", 4: "end code 2102", 5: "shorter than a response head", 6: "no payload",
    }


def test_aliases_and_setpoints(spark):
    df = spark.createDataFrame([(s,) for s in ("ai", "AI", "analog-input", "0", "msv", "9999", "nonsense")], "s string")
    assert [r[0] for r in df.select(catalog.object_type_code(F.col("s"))).collect()] == [0, 0, 0, 0, 19, 9999, None]
    props = df.select(catalog.property_code(F.lit("pv")), catalog.property_code(F.lit("4194303"))).first()
    assert list(props) == [85, 4194303]
    cases = [
        ("eip", "SINT", "-1", -1), ("eip", "udint", "4000000000", 4000000000), ("eip", "BOOL", "1", True), ("eip", "ULINT", "18446744073709551615", 18446744073709551615),
        ("snmp", "counter64", "5000000000", 5000000000), ("snmp", "Integer", "-12abc", -12), ("s7", "WORD", "0xFFFF", 65535), ("s7", "REAL", "1.5", 1.5),
        ("s7", "STRING", "abcd", "abcd"), ("s7", "BOOL", "T", True), ("s7", "INT", "0b11", 3),
    ]
    wrong = [
        ("eip", "INT", "abc"), ("eip", "UNKNOWN", "1"), ("eip", "SINT", "200"), ("s7", "BYTE", "-1"), ("s7", "REAL", "1e39"), ("snmp", "gauge32", "5000000000"),
        ("snmp", "timeticks", "-1"), ("s7", "BOOL", "maybe"), ("eip", "REAL", "1.0f"), ("s7", "STRING", "abcdefgh"),
    ]
    rows = [(i, "p", p, t, v, 4) for i, (p, t, v, *_) in enumerate([*cases, *wrong])]
    typed_, bad = catalog.validate_setpoints(spark.createDataFrame(rows, "i int, name string, protocol string, type string, value string, string_len int"))
    assert [plain(r["typed"]) for r in typed_.orderBy("i").collect()] == [c[3] for c in cases]
    assert [r["i"] for r in bad.orderBy("i").collect()] == list(range(len(cases), len(rows)))


def test_modbus(spark):
    df = spark.createDataFrame(
        [("s", 1, "holding_register", 1, 100, 1, [1234], "c", 1), ("s", 2, "holding_register", 1, 200, 3, [111, 222, 333], "c", 2),
         ("s", 3, "coil", 1, 50, 1, [1], "c", 3), ("s", 4, "coil", 1, 1999, 2, [1, 1], "c", 4), ("s", 5, "coil", 2, 1, 1, [1], "c", 5),
         ("s", 6, "holding_register", 1, 201, 1, [9], "c", 6), ("s", 7, "coil", 1, 1, 2, [1], "c", 7)],
        "server string, seq long, type string, unitId int, addr int, quantity int, values array<int>, clientAddr string, timestamp long",
    )
    rows, bad = modbus.modbus_writes(df, unit=1)
    assert {r["seq"]: r["modbus_addr"] for r in rows.collect()} == {1: "40101", 2: "40201", 3: "00051", 6: "40202"}
    assert {r["seq"]: r["reason"] for r in bad.collect()} == {4: "illegal data address", 5: "other unit", 7: "illegal data value"}
    image = modbus.register_image(rows)
    got = modbus.read_range(image, "holding_register", 199, 5).orderBy("address").collect()
    assert [r["value"] for r in got] == [0, 111, 9, 333, 0]
    early = modbus.read_range(modbus.register_image(rows, as_of_ns=5), "holding_register", 201, 1).first()
    assert early["value"] == 222


def test_traps(spark):
    text = (
        '{"from":"1.2.3.4:162","version":"v2c","community":"public","timestamp":5,"variables":[{"oid":".1.3.6.1.6.3.1.1.4.1.0",'
        '"value":".1.3.6.1.4.1.20408.1.1","type":"ObjectIdentifier"},{"oid":".1.3","value":"cm91dGVyMQ==","type":"OctetString"},'
        '{"oid":"1.4","value":7,"type":"Integer"},{"oid":"1.5","value":null,"type":"Null"}]}'
    )
    df = spark.createDataFrame(
        [(1, text), (2, "junk"), (3, text + " junk"), (4, '{"variables":[1]}'), (5, '{"variables":"x"}'), (6, None), (7, "[]")],
        "msg_id long, data string",
    )
    head, binds, bad = traps.snmp_traps(df)
    assert head.select("version", "trap_oid", "variables").first() == ("v2c", "1.3.6.1.4.1.20408.1.1", 4)
    got = binds.orderBy("pos").collect()
    assert bytes(got[1]["raw"]) == b"router1" and plain(got[2]["value"]) == 7 and plain(got[3]["value"]) is None
    assert {r["msg_id"]: r["reason"] for r in bad.collect()} == {
        2: "not one JSON value", 3: "not one JSON value", 4: "a variable is no object", 5: "no list of variables",
        6: "not one JSON value", 7: "no list of variables",
    }


def test_heads_over_the_borders_of_pieces(spark):
    """A head is found wherever it lies to the pieces of a block that are searched."""
    short = b"##0004abcdCRCC\r\n"
    for lead in (0, 1, hj212.PIECE - 6, hj212.PIECE - 3, hj212.PIECE - 1, hj212.PIECE, hj212.BLOCK - hj212.PIECE - 2, hj212.BLOCK - 1):
        data = b"x" * lead + b"#" + short + b"##+004" + short[6:] + b"\xff" + short
        rows = spark.createDataFrame([(1, 1, bytearray(data))], "conn int, seq int, bytes binary")
        blocks = hj212._blocks(rows.selectExpr("conn", "seq _seq", "bytes _bytes", "bigint(0) _at", "bigint(octet_length(bytes)) _size"), ["conn"])
        got = sorted((r["_start"], r["_end"]) for r in hj212._heads(blocks, ["conn"]).collect() if r["_end"] < hj212.OPEN)
        at = lead + 1
        assert got == [(at, at + 16), (at + 16, at + 32), (at + 33, at + 49)], lead
