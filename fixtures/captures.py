"""Captures and messages derived from the driver tables, row by row in Spark.

Used by the registered queries and the tests; not part of the package API.
Every builder maps table rows to capture rows without a shuffle, so its size
grows with the table.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagflow.functions import values as V
from tagflow.functions.stages import compute_once
from tagflow.operators.decode import crc16
from tagflow.streaming.stateful import end_mark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tasks a core that a table of few files is dealt to.
TASKS_A_CORE = 4
# Rows of one task at most: what captures of them take must not grow with the table.
ROWS_A_TASK = 100_000


def spread(df: DataFrame, *by: str, streamed: bool = False) -> DataFrame:
    """Rows over all cores, several tasks each, and into more tasks the more rows there are.

    Building and decoding captures is CPU work; a table of one small file would
    run on one core, and one of a few large files in few long tasks. Tables whose files
    give enough tasks come back as they are. Rows are dealt by a hash of the columns
    ``by`` (all by default), which needs no sort of a file's rows as dealing them in turn would.
    ``streamed``: what is made of a row goes on at once, so a task may have any number of them,
    and a table whose files give each core its tasks is not moved.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism * TASKS_A_CORE
    if not streamed:
        tasks = max(tasks, -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks, *(by or df.columns)) if df.rdd.getNumPartitions() < tasks else df


def events(spark: SparkSession, sf_dir: str, streamed: bool = False) -> DataFrame:
    """event_id, user_id, event_type, value, ts_ns, k (the number inside props)."""
    return shape_events(spread(table(spark, sf_dir, "events"), "event_id", "ts", streamed=streamed))


def shape_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("ts_ns"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "props",
    )


def stream_events(spark: SparkSession, sf_dir: str, end: str | None = None) -> DataFrame:
    """The events as a stream; with ``end``, a new folder, one more row there ends the input."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    if end:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != "ts"]
        mark = spark.range(1).select(*nothing, end_mark().cast(schema["ts"].dataType).alias("ts")).select(*schema.names)
        mark.write.parquet(end)
        stream = stream.unionByName(spark.readStream.schema(schema).parquet(end))
    return shape_events(stream)


def points(ev: DataFrame) -> DataFrame:
    """Long points: one per event; type ``error`` stands for a bad point."""
    bad = F.col("event_type") == "error"
    return ev.select(
        F.col("event_id").alias("msg_id"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("pos"),
        F.col("user_id").alias("device"),
        F.col("event_type").alias("name"),
        F.when(bad, None).otherwise(F.col("value")).alias("value"),
        "ts_ns",
        F.when(bad, "read failed").alias("error"),
        "k",
    )


def value_points(ev: DataFrame) -> DataFrame:
    return points(ev).withColumn("value", V.num(F.col("value")))


def _json_point(name: str, value: Column | None = None, ts: Column | None = None, error: str | None = None) -> Column:
    parts = [F.lit(f'{{"name":"{name}"')]
    if value is not None:
        parts += [F.lit(',"value":'), value.cast("string")]
    if ts is not None:
        parts += [F.lit(',"timestamp":'), ts.cast("string")]
    if error is not None:
        parts += [F.lit(f',"error":"{error}"')]
    return F.concat(*parts, F.lit("}"))


def acquisition_messages(ev: DataFrame) -> DataFrame:
    """Per event one message of five elements: temp, k, a doubled name and a bad point."""
    temp = F.when(
        F.col("event_type") == "error", _json_point("temp", error="i/o timeout")
    ).otherwise(_json_point("temp", F.col("value"), F.col("ts_ns")))
    data = F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            temp,
            _json_point("k", F.col("k"), F.col("ts_ns") + 1),
            _json_point("dup", F.lit(1)),
            _json_point("dup", F.col("event_id") % 7),
            _json_point("bad", error="read failed"),
        ),
        F.lit("]"),
    )
    return ev.select(
        F.col("event_id").alias("msg_id"), data.alias("data"), device_metadata().alias("metadata")
    )


def device_metadata() -> Column:
    return F.create_map(F.lit("deviceId"), F.concat(F.lit("dev-"), F.col("user_id").cast("string")))


def flat_messages(ev: DataFrame) -> DataFrame:
    """Flat objects: numeric time, text time, array of two, by event_id."""
    body = F.concat(
        F.lit('"temperature":'), F.col("value").cast("string"), F.lit(',"k":'), F.col("k").cast("string"),
        F.lit(',"window_id":"w"'),
    )
    ts = F.col("ts_ns").cast("string")
    one = F.concat(F.lit("{"), body, F.lit(',"timestamp":'), ts, F.lit("}"))
    text_time = F.concat(F.lit("{"), body, F.lit(',"timestamp":"'), ts, F.lit('"}'))
    two = F.concat(F.lit("["), one, F.lit(',{"k":'), F.col("event_id").cast("string"), F.lit("},{}]"))
    which = F.col("event_id") % 3
    return ev.select(
        F.col("event_id").alias("msg_id"),
        F.when(which == 0, one).when(which == 1, text_time).otherwise(two).alias("data"),
        device_metadata().alias("metadata"),
    )


def series_text(ev: DataFrame) -> Column:
    return F.concat(
        F.lit('{"measurement":"ev_'), F.col("event_type"), F.lit('","tags":{"d":"'), F.col("user_id").cast("string"),
        F.lit('"},"fields":{"v":'), F.col("value").cast("string"), F.lit(',"k":'), F.col("k").cast("string"),
        F.lit('},"timestamp":'), F.col("ts_ns").cast("string"), F.lit("}"),
    )


def series_messages(ev: DataFrame) -> DataFrame:
    """Series JSON as array or single object; every tenth is empty, another unreadable."""
    which = F.col("event_id") % 10
    text = series_text(ev)
    data = (
        F.when(which == 1, text)
        .when(which == 2, "[]")
        .when(which == 3, "not json")
        .otherwise(F.concat(F.lit("["), text, F.lit("]")))
    )
    return ev.select(F.col("event_id").alias("msg_id"), data.alias("data"))


def mixed_messages(ev: DataFrame) -> DataFrame:
    """Point arrays, flat objects, series rows, aggregate results and junk."""
    which = F.col("event_id") % 5
    point = F.concat(F.lit('[{"name":"temp","value":'), F.col("value").cast("string"), F.lit(',"timestamp":'),
                     F.col("ts_ns").cast("string"), F.lit('},{"name":"late","error":"x"}]'))
    flat = F.concat(F.lit('{"temp":'), F.col("k").cast("string"), F.lit(',"timestamp":'), F.col("ts_ns").cast("string"), F.lit("}"))
    agg = F.concat(F.lit('[{"name":1,"temp":'), F.col("k").cast("string"), F.lit(',"timestamp":'), F.col("ts_ns").cast("string"), F.lit("}]"))
    data = (
        F.when(which == 0, point)
        .when(which == 1, flat)
        .when(which == 2, F.concat(F.lit("["), series_text(ev), F.lit("]")))
        .when(which == 3, agg)
        .otherwise(F.lit("plain text"))
    )
    return ev.select(F.col("event_id").alias("msg_id"), data.alias("data"), device_metadata().alias("metadata"))


def series(ev: DataFrame) -> DataFrame:
    """Series rows: measurement by type, tag d, fields v and k."""
    return ev.select(
        F.concat(F.lit("ev_"), F.col("event_type")).alias("measurement"),
        F.create_map(F.lit("d"), F.col("user_id").cast("string")).alias("tags"),
        F.create_map(F.lit("v"), V.num(F.col("value")), F.lit("k"), V.integer(F.col("k"))).alias("fields"),
        "ts_ns",
    )


@F.pandas_udf(T.BinaryType())
def pack(kind: pd.Series, value: pd.Series) -> pd.Series:
    """Big-endian bytes by struct format letter."""
    whole = {"b", "B", "h", "H", "i", "I", "q", "Q"}
    return pd.Series(
        [struct.pack(">" + k, int(v) if k in whole else v) for k, v in zip(kind, value)]
    )


def hj212_segment(ev: DataFrame) -> Column:
    """Data segment of a frame from an event; the command code follows event_id."""
    which = F.col("event_id") % 4
    cn = F.when(which == 0, "2011").when(which == 1, "2051").when(which == 2, "2061").otherwise("2031")
    at = F.date_format(F.timestamp_seconds(F.floor(F.col("ts_ns") / 1_000_000_000)), "yyyyMMddHHmmss")
    value, k = F.col("value").cast("string"), F.col("k").cast("string")
    factors = F.when(
        which == 0, F.concat(F.lit("a34004-Rtd="), value, F.lit(",a34004-Flag=N;a01-ZsRtd="), k)
    ).otherwise(F.concat(F.lit("a34004-Avg="), value, F.lit(",a34004-Cou="), k, F.lit(",a34004-Flag=N")))
    return F.concat(
        F.lit("QN="), at, F.lit("000;ST=32;CN="), cn, F.lit(";PW=123456;MN=D"), F.col("user_id").cast("string"),
        F.lit(";Flag="), (F.col("k") % 6).cast("string"), F.lit(";CP=&&DataTime="), at, F.lit(";"), factors, F.lit("&&"),
    )


def hj212_raw(ev: DataFrame, keep_time: bool = False) -> DataFrame:
    """conn, seq, bytes: one frame per event; every twentieth has a wrong checksum."""
    framed = compute_once(ev, {"_seg": hj212_segment(ev)})
    crc = crc16(F.encode("_seg", "UTF-8"))
    crc = F.when(F.col("event_id") % 20 == 7, crc.bitwiseXOR(F.lit(1).cast("bigint"))).otherwise(crc)
    text = F.concat(
        F.lit("##"), F.format_string("%04d", F.length("_seg")), F.col("_seg"), F.format_string("%04X", crc), F.lit("\r\n")
    )
    return framed.select(
        F.col("user_id").alias("conn"), F.col("event_id").alias("seq"), F.lit(0).alias("frame_no"),
        F.encode(text, "UTF-8").alias("bytes"), *(["ts_ns"] if keep_time else []),
    )


def hj212_segments(ev: DataFrame, keep_time: bool = False) -> DataFrame:
    """Frames cut in two network segments, with noise in front of some."""
    raw = hj212_raw(ev, keep_time)
    noise = F.when(F.col("seq") % 3 == 0, F.lit("noise").cast("binary")).otherwise(F.lit("").cast("binary"))
    parts = F.array(
        F.struct((F.col("seq") * 2).alias("seq"), F.concat(noise, F.expr("substring(bytes, 1, 30 + seq % 40)")).alias("bytes")),
        F.struct((F.col("seq") * 2 + 1).alias("seq"), F.expr("substring(bytes, 31 + seq % 40)").alias("bytes")),
    )
    return raw.select("conn", *(["ts_ns"] if keep_time else []), F.inline(parts))


def hex_of(col: Column, bytes_: int) -> Column:
    return F.lpad(F.hex(col.cast("bigint")), bytes_ * 2, "0")
