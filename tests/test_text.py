from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import one_column
from tagflow.functions import text as X


def check(spark, fn, cases):
    df = one_column(spark, list(cases)).select("i", fn(F.col("s")).alias("got"))
    got = {r["i"]: r["got"] for r in df.collect()}
    assert {s: got[i] for i, s in enumerate(cases)} == cases


def test_to_bool(spark):
    check(
        spark,
        X.to_bool,
        {
            "true": True, "True": True, "1": True, "25.3": True, " 1 ": True, "-3": True, "inf": True, "nan": True,
            "0x1p-2": True, "": False, "false": False, "0": False, "null": False, "abc": False, "0.0": False,
            "1.0d": False, "1e999": False, "0x0p0": False,
        },
    )


def test_duration(spark):
    cases = {
        "3s": 3000, "500ms": 500, "1h30m": 5_400_000, "1.5s": 1500, "300us": 0, "-2s": -2000, "+1ms": 1, "0": 0,
        " 7s ": 7000, ".5s": 500, "1.s": 1000, "2562047h": 9_223_369_200_000, "bad": None, "": None, "3": None,
        "1s2": None, "3000000h": None, "1 s": None,
    }
    check(spark, X.duration_ms, cases)
    assert {s: X.parse_duration_ms(s) for s in cases} == cases


def test_integers(spark):
    df = one_column(spark, ["12", "-7", "0x1F", "0b101", "0o17", "017", "1_0", "0x_1F", "12abc", "", "+5", "0", "99999999999999999999"])
    got = [None if r[0] is None else int(r[0]) for r in df.orderBy("i").select(X.parse_integer(F.col("s"))).collect()]
    assert got == [12, -7, 31, 5, 15, 15, None, 31, None, None, 5, 0, 99999999999999999999]


def test_templates(spark):
    df = spark.createDataFrame([('{"k":7,"o":{"p":"q"}}', {"id": "dev-01"})], "msg string, meta map<string,string>")
    cases = {
        "a": "a",
        "${metadata.id}": "dev-01",
        "x${msg.k}y${metadata.id}z": "x7ydev-01z",
        "${msg.o.p}": "q",
        "[${msg.none}]": "[]",
        "${broken": "${broken",
        "${other.x} ${msg.k}": "${other.x} ${msg.k}",
    }
    fixed = df.select(*[X.render_template(t, F.col("msg"), F.col("meta")) for t in cases]).first()
    assert list(fixed) == list(cases.values())
    varying = df.select(*[X.render_column(F.lit(t), F.col("msg"), F.col("meta")) for t in cases]).first()
    assert list(varying) == list(cases.values())


def test_rendered_text_is_not_filled_again(spark):
    df = spark.createDataFrame([({"a": "${metadata.b}", "b": "no"},)], "meta map<string,string>")
    assert df.select(X.render_column(F.lit("${metadata.a}"), F.lit("{}"), F.col("meta"))).first()[0] == "${metadata.b}"


@pytest.mark.parametrize(
    "server,want",
    [
        ("h", ("h", 502)), ("h:10", ("h", 10)), ("[::1]:99", ("::1", 99)), ("::1", ("::1", 502)), ("h:", (None, None)),
        ("h:0", (None, None)), ("h:70000", (None, None)), ("h:x", (None, None)), (" ", (None, None)),
    ],
)
def test_server(spark, server, want):
    host, port = X.split_server(F.col("s"), 502)
    assert tuple(one_column(spark, [server]).select(host, port).first()) == want


def test_timeouts(spark):
    check(
        spark,
        X.is_timeout,
        {
            "request timeout (after 0 retries)": True, "read udp: i/o timeout": True, "context deadline exceeded": True,
            "tooBig": False, "end code 0x0001": False, "connection refused": False,
        },
    )
