from __future__ import annotations

import struct

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import fields_of, plain
from entry_queries.decode import METER, meter_reading
from tagflow.functions import values as V
from tagflow.operators import decode
from tagflow.operators.series import flat_to_series
from tagflow.schemas import SeriesMapping
from tagflow.sources import line_protocol as L
from tagflow.sources import commits, store


def lines(spark, *texts):
    series, rejects = L.read_line_protocol(spark.createDataFrame([(t,) for t in texts], "value string"), default_ts=F.lit(9))
    return series.collect(), rejects.collect()


def test_line_protocol_types_and_escapes(spark):
    (row,), rejects = lines(
        spark, 'my\\ m\\,x,tag\\ k=a\\=b,z=1 f=1.5,i=-3i,u=18446744073709551615u,t=T,n=false,s="q\\"uo\\\\te, x=1 ",e=1e3 123'
    )
    assert rejects == []
    assert row["measurement"] == "my m,x" and row["tags"] == {"tag k": "a=b", "z": "1"} and row["ts_ns"] == 123
    got = {k: plain(v) for k, v in row["fields"].items()}
    assert got == {"f": 1.5, "i": -3, "u": 18446744073709551615, "t": True, "n": False, "s": 'q"uo\\te, x=1 ', "e": 1000.0}


def test_line_protocol_defaults_and_rejects(spark):
    series, rejects = lines(spark, "", "# note", "m v=1", "m,a=b", "m v=abc", "m v=1 99999999999999999999", "m,t= v=1", "m v=1,")
    assert [(r["measurement"], r["tags"], r["ts_ns"]) for r in series] == [("m", {}, 9)]
    assert len(rejects) == 5


def test_line_protocol_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.range(3).select(
        F.concat(F.lit("m ,"), F.col("id").cast("string")).alias("measurement"),
        F.create_map(F.lit("a b"), F.lit("x,=y"), F.lit("none"), F.lit("")).alias("tags"),
        F.create_map(
            F.lit("n"), V.num(F.col("id") + 0.5), F.lit("i"), V.integer(F.col("id")), F.lit("b"), V.boolean(F.col("id") > 0),
            F.lit("s"), V.text(F.lit('say "hi" \\ there')), F.lit("bad"), V.num(F.lit(float("nan"))),
        ).alias("fields"),
        (F.col("id") + 1).alias("ts_ns"),
    )
    L.write_line_protocol(df, path)
    back, rejects = L.read_line_protocol(path, spark)
    assert rejects.count() == 0
    got = {r["measurement"]: r for r in back.collect()}
    assert fields_of(got["m ,2"]) == {"n": 2.5, "i": 2.0, "b": True, "s": 'say "hi" \\ there'}
    assert got["m ,0"]["tags"] == {"a b": "x,=y"}


def test_store_prunes_and_fills_time(spark, tmp_path):
    path = str(tmp_path / "series")
    day = 86_400 * 10**9
    df = spark.range(10).select(
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("measurement"),
        F.create_map(F.lit("d"), F.col("id").cast("string")).alias("tags"),
        F.create_map(F.lit("v"), V.integer(F.col("id"))).alias("fields"),
        (F.col("id") * day).alias("ts_ns"),
    )
    store.write_series(df, path, default_ts=F.lit(7 * day + 1))
    out = store.query_series(spark, path, "even", fields=["v"], start_ns=3 * day, end_ns=8 * day)
    assert sorted((int(plain(r["v"])), r["ts_ns"]) for r in out.collect()) == [(0, 7 * day + 1), (4, 4 * day), (6, 6 * day)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan and "PushedFilters: [IsNotNull(ts_ns)" in plan
    assert store.query_series(spark, path, tags={"d": "3"}).count() == 1
    assert store.query_series(spark, path, sql="select count(*) as n from series").first()["n"] == 10


def rows_read(df):
    """Rows that the scan gave on, after it skipped row groups."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    todo, total = [node], 0
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName() or node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_layout_skips_what_is_not_asked_for(spark, tmp_path):
    path, layout = str(tmp_path / "series"), store.Layout(("host",), 4)
    host = F.concat(F.lit("h"), (F.col("id") % 200).cast("string"))
    df = spark.range(4000).select(
        F.when(F.col("id") >= 0, "cpu").alias("measurement"),
        F.when(F.col("id") % 200 == 7, F.create_map(F.lit("host"), host, F.lit("rack"), F.lit("r1")))
        .when(F.col("id") % 200 == 8, F.create_map(F.lit("rack"), F.lit("r1")))
        .otherwise(F.create_map(F.lit("host"), host)).alias("tags"),
        F.create_map(F.lit("v"), V.integer(F.col("id"))).alias("fields"), (F.col("id") + 1).alias("ts_ns"),
    )
    store.write_series(df, path, layout=layout)
    assert store.query_series(spark, path, layout=layout).columns == store.query_series(spark, path).drop("tag_host").columns
    assert store.query_series(spark, path, layout=layout).count() == 4000
    for tags, n in (({"host": "h7"}, 20), ({"host": "h7", "rack": "r1"}, 20), ({"rack": "r1"}, 40), ({"host": "none"}, 0)):
        assert store.query_series(spark, path, tags=tags, layout=layout).count() == n
        assert store.query_series(spark, path, tags=tags).count() == n
    by_tag = store.query_series(spark, path, "cpu", {"host": "h9"}, layout=layout)
    assert "EqualTo(tag_host,h9)" in by_tag._jdf.queryExecution().executedPlan().toString()
    # One host is in one bucket; the other files are skipped by dictionary or Bloom filter.
    assert 20 <= rows_read(by_tag) < 2000 and rows_read(store.query_series(spark, path, "cpu", {"host": "none"}, layout=layout)) == 0
    for tags, n in (({"host": "h7"}, 0), ({"rack": "r1", "host": "h7"}, 20), ({"rack": "r1"}, 20), ({}, 0)):
        one = store.query_series(spark, path, "cpu", tags, layout=layout, whole_tags=True)
        assert one.count() == n and rows_read(one) < 2000
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(series_id" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    files = list((tmp_path / "series").glob("measurement=cpu/date=*/bucket=1/*.parquet"))
    for file in files:
        ids = pq.read_table(file, columns=["series_id"], partitioning=None)["series_id"].to_pylist()
        assert ids == sorted(ids) and len(set(ids)) < 200
    assert files


def test_series_ids_tell_tags_apart(spark):
    made = [{"a": "1", "b": "2"}, {"a": "1", "b": None}, {"a": "1"}, {"a=1": "2"}, {}, {"a": "1=2:b"}]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "i int, tags map<string,string>")
    got = {r["id"] for r in df.select(store.series_id(F.lit("m"), F.col("tags")).alias("id")).collect()}
    assert len(got) == len(made)
    turned = spark.sql("select map('b', '2', 'a', '1') as t, map('a', '1', 'b', '2') as u, cast(null as map<string,string>) as n, map() as e")
    row = turned.select(*[store.series_id(F.lit("m"), F.col(c).cast("map<string,string>")).alias(c) for c in "tune"]).first()
    assert row["t"] == row["u"] and row["n"] == row["e"]


def test_decoded_telegrams_reach_the_store(spark, tmp_path):
    """Capture, decoder, flat rows, series, store and back."""
    telegram = lambda unit, total, level: (h := struct.pack("<cBIH", b"Q", unit, total, level)) + bytes([sum(h) % 256])
    bad = bytearray(telegram(4, 1, 1))
    bad[3] ^= 1
    captures = spark.createDataFrame(
        [("c", 1, telegram(4, 70_000, 12_500)), ("c", 2, telegram(4, 70_003, 9_000)), ("c", 3, bytes(bad)), ("c", 4, b"")],
        "device string, seq long, bytes binary",
    )
    rows, rejects = decode.decode_with(captures, meter_reading, METER)
    assert {r["seq"]: r["reason"] for r in rejects.collect()} == {3: "bytes do not add up", 4: "a telegram has 9 bytes, not 0"}
    messages = rows.select(
        F.col("seq").alias("msg_id"), F.to_json(F.struct("total", "level", F.col("seq").alias("timestamp"))).alias("data"),
        F.create_map(F.lit("unit"), F.col("unit").cast("string")).alias("metadata"),
    )
    series = flat_to_series(messages, SeriesMapping("meter", (("unit", "${metadata.unit}"),)), F.lit(5)).drop("msg_id", "row")
    path = str(tmp_path / "meter")
    store.write_series(series, path)
    (row,) = store.latest_series(store.query_series(spark, path), ["measurement"]).collect()
    assert fields_of(row) == {"total": 70_003.0, "level": 9.0} and (row["tags"], row["ts_ns"]) == ({"unit": "4"}, 2)
    ties = store.query_series(spark, path).withColumn("ts_ns", F.lit(1))
    assert len({str(store.latest_series(ties.repartition(n), ["measurement"]).first()) for n in (1, 2, 3)}) == 1


def read_files(spark, folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.txt").write_bytes(text.encode())
    series, rejects = L.read_line_protocol(str(folder), spark, default_ts=F.lit(9))
    notes = sorted((r["measurement"], plain(r["fields"]["s"]) if "s" in r["fields"] else None) for r in series.collect())
    return notes, sorted(r["line"] for r in rejects.collect())


def test_values_over_line_ends(spark, tmp_path):
    text = 'a s="x\ny",n=1i 5\nb n=2\n  c s="1\n\n# no note\nd n=3 4\\"\n",t="p\nq",n=1\n# "note\ne s="in one"\n'
    notes, rejects = read_files(spark, tmp_path / "whole", f=text)
    assert notes == [("a", "x\ny"), ("b", None), ("c", '1\n\n# no note\nd n=3 4"\n'), ("e", "in one")] and rejects == []


def test_open_values_take_nothing_with_them(spark, tmp_path):
    # Never closed; closed by something that cannot be; an empty value opened at a line's end.
    notes, rejects = read_files(
        spark, tmp_path / "open",
        f='a s="x\nb n=1\nc s="1"\nd s="2\n3"\n', g='e s="x\nf n=1\n', h='g s="\nh s="v"\ni s="\n"\n', empty="",
    )
    assert notes == [("b", None), ("c", "1"), ("d", "2\n3"), ("f", None), ("h", "v"), ("i", "\n")]
    assert rejects == ['a s="x', 'e s="x', 'g s="']


def test_values_over_blocks_of_a_file(spark, tmp_path):
    """Blocks of 64 bytes: records begin, go on and end in different ones; some span several."""
    import random

    rng = random.Random(5)
    text, want = [], []
    for i in range(200):
        note = "n" + "\n".join("z" * rng.choice((0, 3, 40, 90)) for _ in range(rng.choice((1, 1, 2, 5))))
        if rng.random() < 0.1:
            text.append(f'bad{i} s="open')
        text.append(f'm{i} s="{note}" {i + 1}')
        want.append((f"m{i}", note))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64b")
    try:
        notes, rejects = read_files(spark, tmp_path / "blocks", f="\n".join(text) + "\n")
    finally:
        spark.conf.set(size, before)
    assert notes == sorted(want) and rejects == sorted(t for t in text if t.startswith("bad"))


def batch_rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int").select(
        F.lit("m").alias("measurement"), F.create_map(F.lit("d"), (F.col("v") % 3).cast("string")).alias("tags"),
        F.create_map(F.lit("v"), V.integer(F.col("v"))).alias("fields"), F.col("v").cast("bigint").alias("ts_ns"),
    )


def test_batches_are_valid_when_complete(spark, tmp_path):
    path = str(tmp_path / "batches")
    store.write_batch(batch_rows(spark, 1, 2), path, 0, F.lit(9))
    store.write_batch(batch_rows(spark), path, 1, F.lit(9))
    # Written without a commit, as by an attempt that was stopped.
    store.write_series(batch_rows(spark, 50), f"{path}/batch_id=2", default_ts=F.lit(9))

    def times():
        return sorted(r["ts_ns"] for r in store.query_series(spark, path).collect())

    assert times() == [1, 2]
    store.write_batch(batch_rows(spark, 3), path, 2, F.lit(9))
    store.write_batch(batch_rows(spark, 4, 5), path, 2, F.lit(9))
    assert times() == [1, 2, 3]


def test_compaction_merges_levels(spark, tmp_path):
    path, layout = str(tmp_path / "small"), store.Layout(("d",), 2)
    for batch in range(5):
        store.write_batch(batch_rows(spark, 2 * batch + 1, 2 * batch + 2), path, batch, F.lit(9), layout)
    made = store.compact_batches(spark, path, layout, fan_in=2)
    assert [(e.first, e.last, e.level) for e in made] == [(0, 1, 1), (2, 3, 1), (0, 3, 2)]

    def values(**how):
        return sorted(int(plain(r["v"])) for r in store.query_series(spark, path, "m", fields=["v"], layout=layout, **how).collect())

    assert values() == list(range(1, 11)) and values(tags={"d": "0"}) == [3, 6, 9]
    # A late second attempt of a merged batch adds nothing.
    store.write_batch(batch_rows(spark, 1, 2), path, 0, F.lit(9), layout)
    assert len(commits.vacuum(spark, path)) == 6 and not (tmp_path / "small" / "batch_id=0").exists()
    assert values() == list(range(1, 11)) and [(e.first, e.last) for e in commits.entries(spark, path)] == [(0, 3), (4, 4)]
    assert store.compact_batches(spark, path, layout, fan_in=2) == [] and commits.vacuum(spark, path) == []
