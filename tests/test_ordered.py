"""Hot keys: slices of any width give what one ordered pass gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tagflow.operators import decode, control, sequence
from tagflow.operators import windows as W
from tagflow.operators.hj212 import cut_segments, feed, skipped_bytes, split_frames
from tagflow.operators.intervals import first_disjoint
from tagflow.operators.ordered import Ordered, row_number

NS = 1_000_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows belong to one key; times repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        key = 0 if rng.random() < 0.5 else rng.randrange(1, 40)
        rows.append((key, rng.randrange(500) * 1000 * NS, i, rng.randrange(100), rng.choice("abc")))
    return spark.createDataFrame(rows, "device long, ts_ns long, seq long, k long, name string").cache()


def as_list(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("width", ["1h", "7s", 1])
def test_ordered_values(skewed, width):
    o = Ordered.of(skewed, ["device"], ["ts_ns", "seq"], width)
    known = F.when(F.col("k") > 90, F.col("k"))
    o = o.add(
        before=o.previous(F.col("k")), after=o.following(F.col("k")), last=o.newest(known), next=o.upcoming(known),
        total=o.total(F.col("k")), rn=row_number(o),
    )
    got = {(r["device"], r["ts_ns"], r["seq"]): r[5:] for r in o.df.collect()}
    want = {}
    by_key = {}
    for r in skewed.collect():
        by_key.setdefault(r["device"], []).append(r)
    for key, rows in by_key.items():
        rows.sort(key=lambda r: (r["ts_ns"], r["seq"]))
        last, total = None, 0
        for i, r in enumerate(rows):
            last = r["k"] if r["k"] > 90 else last
            total += r["k"]
            after = next((x["k"] for x in rows[i + 1 :] if x["k"] > 90), None)
            want[key, r["ts_ns"], r["seq"]] = (
                rows[i - 1]["k"] if i else None, rows[i + 1]["k"] if i + 1 < len(rows) else None, last, after, total, i + 1,
            )
    assert got == want


@pytest.mark.parametrize("limit", ["3s", 1])
def test_operators_do_not_depend_on_slices(skewed, limit):
    plain = "1000h"
    timed = W.event_time(skewed)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("k").alias("s")]
    for order in (["event_time"], ["event_time", "seq"]):
        a, b = (W.session(timed, "3s", aggs, ["device"], order, width=m) for m in (plain, limit))
        assert as_list(a.select("device", "window.start", "window.end", "n", "s")) == as_list(
            b.select("device", "window.start", "window.end", "n", "s")
        )
    a, b = (W.count_window(skewed, 7, aggs, ["device"], width=m) for m in (plain, limit))
    assert as_list(a) == as_list(b)
    a, b = (W.changes(skewed, ["device"], value="k", epsilon=3, width=m) for m in (plain, limit))
    assert as_list(a.select("device", "seq", "previous").fillna(-1)) == as_list(b.select("device", "seq", "previous").fillna(-1))
    steps = ["name = 'a'", "name = 'b'", "name = 'c'"]
    a, b = (sequence.sequence_match(skewed, steps, "20s", width=m) for m in (plain, limit))
    assert as_list(a) == as_list(b) == sequence_by_hand(skewed, "abc", 20_000 * NS)
    signal = skewed.withColumn("input", F.col("k") > 50)
    for fn in (control.timer_ton, control.timer_tof):
        a, b = (fn(signal, pt="2s", width=m).select("device", "seq", "ts_ns", "kind", "q") for m in (plain, limit))
        assert as_list(a) == as_list(b)


def sequence_by_hand(df, steps, within):
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r["device"], []).append(r)
    out = []
    for key, rows in by_key.items():
        rows.sort(key=lambda r: (r["ts_ns"], r["seq"]))
        free = 0
        for i, r in enumerate(rows):
            if i < free or r["name"] != steps[0]:
                continue
            at = i
            for s in steps[1:]:
                at = next((j for j in range(at + 1, len(rows)) if rows[j]["name"] == s), None)
                if at is None:
                    break
            if at is not None and rows[at]["ts_ns"] - r["ts_ns"] <= within:
                out.append((key, r["ts_ns"], rows[at]["ts_ns"]))
                free = at + 1
    return sorted(out)


@pytest.mark.parametrize("limit", [1024, 3])
def test_frames_across_blocks(spark, limit):
    rng = random.Random(3)
    rows, want, skipped = [], [], {}
    for conn in range(5):
        stream, ends, noise = b"", [], 0
        for i in range(60 if conn == 0 else 6):
            body = bytes(rng.choice(b"abc&=;") for _ in range(rng.choice([1, 40, 120, 2500])))
            junk = rng.choice([b"", b"x##", b"##0000", b"#", b"noise "])
            frame = b"##%04d" % len(body) + body + b"CRCC\r\n"
            stream += junk + frame
            noise += len(junk)
            ends.append((len(stream), frame))
        at, seq, cuts = 0, 0, []
        while at < len(stream):
            n = rng.choice([rng.randrange(1, 90), 3000])
            rows.append((conn, seq, stream[at : at + n]))
            cuts.append(min(at + n, len(stream)))
            at, seq = at + n, seq + 1
        numbers = {}
        for end, frame in ends:
            s = next(i for i, c in enumerate(cuts) if c >= end)
            want.append((conn, s, numbers.setdefault(s, 0), frame))
            numbers[s] += 1
        skipped[conn] = noise
    df = spark.createDataFrame(rows, "conn long, seq long, bytes binary")
    got = sorted((r["conn"], r["seq"], r["frame_no"], bytes(r["bytes"])) for r in split_frames(df, width=limit).collect())
    assert got == sorted(want) and len(want) > 50
    left = {}
    for r in skipped_bytes(df, width=limit).collect():
        left[r["conn"]] = left.get(r["conn"], 0) + len(r["bytes"])
    assert left == {c: n for c, n in skipped.items() if n}


def test_keys_stay_exact_beside_nulls(spark):
    big = 2**60 + 1
    frame = b"##0004abcdCRCC\r\n"
    df = spark.createDataFrame(
        [(big, big, frame[:5]), (big, big + 1, frame[5:]), (None, 1, frame[:7]), (None, 2, frame[7:]), (big - 1, None, frame), (3, 1, None)],
        "conn long, seq long, bytes binary",
    )
    got = {(r["conn"], r["seq"], bytes(r["bytes"])) for r in split_frames(df).collect()}
    assert got == {(big, big + 1, frame), (None, 2, frame), (big - 1, None, frame)}
    events = spark.createDataFrame(
        [(big, 1, 1, "a"), (big, 2, 2, "b"), (None, 1, 3, "a"), (None, 2, 4, "b"), (big - 1, 1, 5, "a"), (big, None, 6, "b")],
        "device long, ts_ns long, seq long, name string",
    )
    found = sequence.sequence_match(events, ["name = 'a'", "name = 'b'"], "1s")
    assert {tuple(r) for r in found.select("device", "start_ts_ns", "end_ts_ns").collect()} == {(big, 1, 2), (None, 1, 2)}


def test_decoder_keys_stay_exact(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big, 1, b"x"), (None, 2, b"yy"), (5, None, None)], "device long, seq long, bytes binary")
    rows, rejects = decode.decode_with(df, lambda b: (len(b),), "n long")
    assert {tuple(r) for r in rows.collect()} == {(big, 1, 1), (None, 2, 2)}
    assert [(r["device"], r["seq"]) for r in rejects.collect()] == [(5, None)]


def test_plans_start_no_job(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    timed = W.event_time(skewed)
    signal = skewed.withColumn("input", F.col("k") > 50)
    W.session(timed, "3s", [F.count(F.lit(1)).alias("n")], ["device"])
    W.count_window(skewed, 7, [F.count(F.lit(1)).alias("n")], ["device"])
    W.changes(skewed, ["device"], value="k")
    control.timer_ton(signal, pt="2s")
    control.timer_tof(signal, pt="2s")
    control.watchdog(signal.withColumn("data", F.lit("x")), "f", timeout="2s")
    jobs = list(tracker.getJobIdsForGroup("plans"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == []


@pytest.mark.parametrize("touching", [False, True])
def test_disjoint_intervals(spark, touching):
    """Long runs of overlaps, nested, equal and repeated candidates, null keys."""
    rng = random.Random(11)
    rows = []
    for key, span in ((None, 3), (1, 40), (2, 400), (2**60 + 1, 6)):
        for _ in range(250 if key == 2 else 60):
            at = rng.randrange(600)
            rows.append((key, at, at + rng.randrange(1, span)))
    rows += rows[:40]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    want = []
    for key in {r[0] for r in rows}:
        end = None
        for a, b in sorted({(a, b) for k, a, b in rows if k == key}):
            if end is None or a > end or (touching and a == end):
                want.append((key, a, b))
                end = b
    for width in (1000, 7):
        got = first_disjoint(df, ["k"], ["a"], ["b"], touching, width)
        assert sorted(map(tuple, got.collect()), key=lambda r: (str(r[0]), r[1])) == sorted(want, key=lambda r: (str(r[0]), r[1]))


def test_frames_by_scan(spark):
    """Against the scan of the stream form: heads inside frames, cut heads, open frames, many blocks."""
    rng = random.Random(13)
    rows, want, outside = [], [], {}
    parts = [b"##0004abcdCRCC\r\n", b"##+012##0004xxxx##CRCC\r\n", b"##", b"#", b"##00", b"##0000", b"noise", b"##9999" + b"z" * 700, b"###0001aCRCC\r\n", b"\xff\xc3"]
    for conn in range(14):
        stream = b"".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 30])))
        stream = stream * (300 if conn == 0 else 1)
        at, seq, buffer = 0, 0, b""
        left = b""
        while at < len(stream):
            n = rng.choice([1, 2, 5, 40, 9000])
            piece = stream[at : at + n]
            rows.append((conn, seq, piece))
            buffer, found = feed(buffer, piece)
            number = 0
            for data, reason in found:
                if reason is None:
                    want.append((conn, seq, number, data))
                    number += 1
                else:
                    left += data
            at, seq = at + n, seq + 1
        outside[conn] = left
    df = spark.createDataFrame(rows + [(99, 0, b""), (99, 1, None)], "conn long, seq long, bytes binary")
    got = cut_segments(df).collect()
    assert sorted((r["conn"], r["seq"], r["frame_no"], bytes(r["bytes"])) for r in got if r["reason"] is None) == sorted(want)
    noise = {}
    for r in sorted((r for r in got if r["reason"]), key=lambda r: (r["conn"], r["seq"], r["frame_no"])):
        noise[r["conn"]] = noise.get(r["conn"], b"") + bytes(r["bytes"])
    assert noise == {c: b for c, b in outside.items() if b}
    assert cut_segments(df.limit(0)).count() == 0


def test_products_half_way_do_not_follow_the_order_of_rows(spark):
    """58.01125 * 22.702 is 1316.9713975; the averages come with or without an error in the last digit."""
    from entry_queries.windows import product

    rows = [(v, c) for v in (58.01124999999999, 58.01125, 58.011250000000004) for c in (22.701999999999998, 22.702, 22.702000000000005)]
    got = spark.createDataFrame(rows, "view double, click double").select(product().alias("p")).collect()
    assert {r["p"] for r in got} == {1316.971398}
    assert spark.createDataFrame([(58.0112, 22.7019)], "view double, click double").select(product().alias("p")).first()["p"] == 1316.964461
