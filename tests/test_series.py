from __future__ import annotations

from pyspark.sql import functions as F

from helpers import fields_of, plain
from tagflow.functions import values as V
from tagflow.operators import points as P
from tagflow.operators import series as S
from tagflow.schemas import SeriesMapping
from tagflow.sources import messages as M

META = {"line": "L7", "hall": "north"}
PRESS = SeriesMapping("press", (("line", "${metadata.line}"),))


def messages(spark, *texts):
    return spark.createDataFrame([(i, t, META) for i, t in enumerate(texts)], "msg_id long, data string, metadata map<string,string>")


def dispatch(spark, mapping, *texts):
    mapped, passed = S.dispatch_shape(messages(spark, *texts), mapping, F.lit(42))
    return mapped.orderBy("msg_id", "row").collect(), [r["msg_id"] for r in passed.orderBy("msg_id").collect()]


def test_one_row_for_each_batch(spark):
    """Good points of a batch share a row; its time is the newest of them, with or without a mapping for that point."""
    strokes = '[{"name":"strokes","value":118,"timestamp":40},{"name":"oil","value":-0.5,"timestamp":90}]'
    broken = '[{"name":"oil","error":"sensor lost","timestamp":999},{"name":"strokes","value":119,"timestamp":41}]'
    untimed = '[{"name":"strokes","value":0}]'
    rows, passed = dispatch(spark, PRESS, strokes, broken, untimed)
    assert passed == [] and {r["measurement"] for r in rows} == {"press"} and all(r["tags"] == {"line": "L7"} for r in rows)
    assert [(fields_of(r), r["ts_ns"]) for r in rows] == [({"strokes": 118.0, "oil": -0.5}, 90), ({"strokes": 119.0}, 41), ({"strokes": 0.0}, 0)]
    only = SeriesMapping("press", (), (("n", "strokes"),))
    assert [(fields_of(r), r["ts_ns"]) for r in dispatch(spark, only, strokes)[0]] == [({"n": 118.0}, 90)]


def test_fields_can_swap_names(spark):
    text = '[{"name":"left","value":1},{"name":"right","value":2}]'
    swapped = SeriesMapping("m", (), (("left", "right"), ("right", "left")))
    assert [fields_of(r) for r in dispatch(spark, swapped, text)[0]] == [{"left": 2.0, "right": 1.0}]
    doubled = SeriesMapping("m", (), (("both", "left"), ("copy", "left"), ("both", "right"), ("", "left")))
    assert [fields_of(r) for r in dispatch(spark, doubled, text)[0]] == [{"both": 2.0, "copy": 1.0}]
    assert dispatch(spark, SeriesMapping("m", (), (("left", "middle"),)), text) == ([], [0])


def test_every_flat_object_is_a_row(spark):
    one, many = '{"open":true,"lid":"shut"}', '[{"n":3},{},{"n":4,"note":"é"},{"window_id":9}]'
    rows, passed = dispatch(spark, PRESS, one, many, "[{}]")
    assert [(r["msg_id"], fields_of(r)) for r in rows] == [(0, {"open": True, "lid": "shut"}), (1, {"n": 3.0}), (1, {"n": 4.0, "note": "é"})]
    assert {r["ts_ns"] for r in rows} == {42} and passed == [2]


def test_row_times(spark):
    """Only a number is a time, also a negative one and one with a fraction; the window's own key is never stored."""
    rows, passed = dispatch(
        spark, PRESS, '{"n":1,"timestamp":-8}', '{"n":2,"timestamp":77.9}', '{"n":3,"timestamp":true,"window_id":"a"}',
        '{"timestamp":5,"window_id":"b"}',
    )
    assert [(fields_of(r), r["ts_ns"]) for r in rows] == [({"n": 1.0}, -8), ({"n": 2.0}, 77), ({"n": 3.0, "timestamp": True}, 42)]
    assert passed == [3]


def test_other_messages_pass_through(spark):
    ready = '{"measurement":"oven","tags":{},"fields":{"deg":180,"fan":false},"timestamp":9}'
    texts = (ready, f"[{ready},{ready}]", " ", "[ ]", "{open", "true", '"text"', '[{"name":"deg","error":"lost"}]', '{"deg":1} {"deg":2}')
    rows, passed = dispatch(spark, PRESS, *texts)
    assert rows == [] and passed == list(range(len(texts)))
    assert dispatch(spark, SeriesMapping(), '{"deg":1}') == ([], [0])


def test_first_element_decides_the_shape(spark):
    rows, _ = dispatch(
        spark, PRESS, '[{"name":"t","value":1},{"value":2}]', '[{"value":2},{"name":"t","value":1}]',
        '[{"name":"t","value":1},{"name":5}]', '[{"name":"t","value":{"a":[1]}}]',
    )
    assert [r["shape"] for r in rows] == ["points", "flat", "flat", "flat", "flat", "points"]
    assert plain(rows[-1]["fields"]["t"]) == '{"a":[1]}'


def test_last_duplicate_wins_in_both_forms(spark):
    text = '[{"name":"a","value":1},{"name":"a","value":2},{"name":"a","error":"x"},{"name":"","value":9,"timestamp":77},{"name":"b","value":true}]'
    (row,), _ = dispatch(spark, PRESS, text)
    want = {"a": 2.0, "b": True}
    assert fields_of(row) == want and row["ts_ns"] == 0
    pts = M.read_points(messages(spark, text, '[{"name":"q","error":"x"}]'))
    series, rest = S.pivot_points(pts, SeriesMapping("press"))
    (long,) = series.collect()
    assert fields_of(long) == want and {r["msg_id"] for r in rest.collect()} == {1}


def test_value_kinds_and_validity(spark):
    text = '{"i":1,"d":1.5,"big":18446744073709551615,"huge":1e30,"s":"x","b":false,"n":null,"o":{"p":1},"e":2e3}'
    (row,), _ = dispatch(spark, PRESS, text)
    kinds = {k: v["kind"] for k, v in row["fields"].items()}
    assert kinds == {"i": "int", "d": "num", "big": "int", "huge": "num", "s": "str", "b": "bool", "n": "null", "o": "json", "e": "num"}
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (0.0,)], "x double")
    assert [r[0] for r in df.select(V.is_storable(V.num(F.col("x")))).collect()] == [False, False, False, False, True]
    kept = S.valid_fields(df.select(F.create_map(F.lit("x"), V.num(F.col("x"))).alias("fields")))
    assert kept.count() == 1


def test_scaling(spark):
    cases = [(4.0, 0.25, -1.0, 0.0), (7.0, 0.0, 0.0, 7.0), (7.0, 0.0, -2.5, -2.5), (7.0, 3.0, 0.0, 21.0), (7.0, None, None, 7.0)]
    df = spark.createDataFrame([c[:3] for c in cases], "v double, s double, o double")
    got = df.select(P.scale_value(V.num(F.col("v")), F.col("s"), F.col("o")).alias("x")).collect()
    assert [plain(r["x"]) for r in got] == [c[3] for c in cases]
    other = df.limit(1).select(
        P.scale_value(V.boolean(F.lit(True)), F.lit(2.0), F.lit(1.0)).alias("b"),
        P.scale_value(V.text(F.lit("abc")), F.lit(2.0), F.lit(1.0)).alias("s"),
    ).first()
    assert plain(other["b"]) is True and plain(other["s"]) == "abc"


def test_point_source(spark):
    batch = spark.createDataFrame(
        [(0, "d", '[{"name":"own","addr":"9"},{"name":"too"}]'), (1, "d", "\n"), (2, "d", "{]"), (3, "d", " null "), (4, "d", "[ ]"), (5, "none", None)],
        "msg_id long, device string, data string",
    )
    catalog = spark.createDataFrame(
        [("d", 0, "cfg", "a", "", 0.0, 0.0, "", "")],
        "device string, pos int, name string, addr string, type string, scale double, offset double, endian string, value string",
    )
    got = {}
    for r in P.resolve_points(batch, catalog).collect():
        got.setdefault(r["msg_id"], []).append((r["name"], r["error"]))
    assert sorted(got[0]) == [("own", None), ("too", None)] and all(got[i] == [("cfg", None)] for i in range(1, 5))
    assert got[5] == [(None, P.NO_POINTS)]


def test_batch_health(spark):
    pts = spark.createDataFrame(
        [(1, 0, "e0"), (1, 1, "e1"), (2, 0, ""), (2, 1, "late")], "msg_id long, pos int, error string"
    )
    got = {r["msg_id"]: r[1:] for r in P.batch_health(pts).collect()}
    assert got == {1: (2, 2, "e1", True), 2: (2, 1, "late", False)}


def test_series_json(spark):
    texts = (
        '[{"measurement":"oven","tags":{"hall":"north"},"fields":{"deg":180},"timestamp":-9}]', '{"measurement":"one","fields":{}}',
        "[]", "junk", '[{"measurement":5}]', '[{"tags":{"a":1}}]', '[{"timestamp":1.5}]',
    )
    series, rejects = M.read_series_json(messages(spark, *texts))
    got = series.orderBy("msg_id").collect()
    assert [(r["measurement"], r["tags"], r["ts_ns"]) for r in got] == [("oven", {"hall": "north"}, -9), ("one", None, 0)]
    assert {r["msg_id"]: r["reason"] for r in rejects.collect()} == {
        2: "no points in message", 3: "not readable as series JSON", 4: "wrong member type", 5: "wrong member type", 6: "wrong member type",
    }


def test_flat_rows_are_read_once(spark):
    """A field map is worked out once, however many fields are picked from it."""
    rows = spark.createDataFrame([(1, '{"a":1,"b":"x","timestamp":7}', None)], "msg_id int, data string, metadata map<string,string>")

    def made(*pairs):
        return S.flat_to_series(rows, SeriesMapping("m", (), pairs), default_ts=F.lit(42))

    mappings = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("transform_values")
    four = made(("p", "a"), ("q", "b"), ("r", "a"), ("timestamp", "timestamp"))
    assert mappings(four) == mappings(made(("p", "a")))
    (row,) = four.collect()
    assert row["ts_ns"] == 7 and {k: plain(v) for k, v in row["fields"].items()} == {"p": 1, "q": "x", "r": 1}


def test_few_files_are_dealt_to_several_tasks_a_core(spark):
    from fixtures import captures as C

    rows = C.spread(spark.range(1000).coalesce(1))
    assert rows.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in rows.collect()) == list(range(1000))


def test_many_rows_are_dealt_to_more_tasks(spark, monkeypatch):
    from fixtures import captures as C

    monkeypatch.setattr(C, "ROWS_A_TASK", 10)
    rows = spark.range(995).select("id", (F.col("id") % 3).alias("x")).unionByName(spark.range(5).select(F.lit(None).cast("long").alias("id"), F.lit(1).cast("long").alias("x")))
    dealt = C.spread(rows.coalesce(1), "id")
    assert dealt.rdd.getNumPartitions() == 100
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    # Rows that go on one by one need tasks for each core only, so a table in enough files is not moved.
    few = C.spread(rows.coalesce(1), "id", streamed=True)
    assert few.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism < 100
    there = rows.repartition(4 * spark.sparkContext.defaultParallelism)
    assert C.spread(there, "id", streamed=True) is there and C.spread(there, "id").rdd.getNumPartitions() == 100


def test_kind_tests_agree_with_the_kind(spark):
    """Told by the type's name or by the written value, a kind is the same: 1.0 and 4e2 count as written out."""
    texts = ["null", '"a"', '"7"', '""', "7", "-3", "9223372036854775807", "9223372036854775808", "1.0", "1.5", "4e2", "true", "{}", '[1,"b"]', None]
    kinds = ["null", "str", "int", "num", "bool", "json"]
    v = F.try_parse_json("t")
    tests = [V.is_kind(v, k).alias(k) for k in kinds] + [V.is_kind(v, "null", "int").alias("both")]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(V.variant_kind(v).alias("kind"), *tests).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [k for k in kinds if r[k]] == [r["kind"]] and r["both"] == (r["kind"] in ("null", "int"))


def test_passed_batches_read_errors_of_listed_names_only(spark):
    """A batch passes unless a good point of it is listed; the error is looked at behind the name, once for each point."""
    texts = ['[{"name":"a","error":""}]', '[{"name":"a","error":"x"},{"name":"z"}]', '[{"name":"z","value":1},{"name":""}]', '[{"name":"z"},{"name":null},{"name":"a"}]']
    mapping = SeriesMapping("m", (), (("b", "a"), ("", "z"), ("c", "")))
    _, rest = S.pivot_points(M.read_points(messages(spark, *texts)), mapping)
    assert sorted((r["msg_id"], r["pos"]) for r in rest.select("msg_id", "pos").collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.splitlines() if "Filter" in line and " IN (" in line or "Filter" in line and "name" in line and "error" in line]
    read = [line for line in tests if "element_at(_row" in line]
    assert read and all(line.index("name") < line.index("error") for line in read)
