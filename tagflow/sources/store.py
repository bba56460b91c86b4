"""Stored series: partitioned parquet, read back by measurement, tags and time.

Rows lie in folders by measurement and date, and by a bucket of the series where the
``Layout`` has several. In a file they are in the order of series and time, so that a row
group holds few series. The series' id and the tags that the layout names are columns of
their own, with statistics and a Bloom filter each: a filter on them is pushed to the
files and skips row groups, which a filter on a map cannot.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagflow.operators.series import valid_fields, write_time_ns
from tagflow.session import write_sized
from tagflow.sources import commits


@dataclass(frozen=True)
class Layout:
    """How a store is laid out; give the same one to all writes and reads of a store.

    ``indexed_tags``: tags that are often asked for. ``buckets``: folders of series under
    a date; choose as many as make the files of one of them fit the usual file size.
    """

    indexed_tags: tuple[str, ...] = ()
    buckets: int = 1

    @property
    def folders(self) -> list[str]:
        return ["measurement", "date"] + (["bucket"] if self.buckets > 1 else [])

    @property
    def tag_columns(self) -> dict[str, str]:
        return {tag: f"tag_{tag}" for tag in self.indexed_tags}

    def bucket_of(self, series: Column) -> Column:
        return F.pmod(series, F.lit(self.buckets)).cast("int")


PLAIN = Layout()


def series_id(measurement: Column, tags: Column) -> Column:
    """64 bits that stand for a measurement with its tags, whatever their order."""
    entries = F.array_sort(F.map_entries(F.coalesce(tags, F.create_map().cast("map<string,string>"))))
    return F.xxhash64(measurement, F.transform(entries, lambda e: F.concat_ws("=", *[_counted(e[k]) for k in ("key", "value")])))


def _counted(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def to_stored(series: DataFrame, default_ts: Column | None = None, layout: Layout = PLAIN) -> DataFrame:
    """Storable rows: valid fields only, unset times filled; ``date`` and the layout's columns added."""
    default_ts = default_ts if default_ts is not None else write_time_ns()
    timed = valid_fields(series).withColumn(
        "ts_ns", F.when(F.coalesce("ts_ns", F.lit(0)) == 0, default_ts).otherwise(F.col("ts_ns")).cast("bigint")
    )
    seconds = F.call_function("div", F.col("ts_ns"), F.lit(1_000_000_000).cast("bigint"))
    named = {c: F.col("tags")[tag] for tag, c in layout.tag_columns.items()}
    out = timed.withColumns(
        {"date": F.to_date(F.timestamp_seconds(seconds)), "series_id": series_id(F.col("measurement"), F.col("tags")), **named}
    )
    return out.withColumn("bucket", layout.bucket_of(F.col("series_id"))) if layout.buckets > 1 else out


def write_series(
    series: DataFrame,
    path: str,
    default_ts: Column | None = None,
    mode: str = "append",
    rebalance: bool = True,
    layout: Layout = PLAIN,
) -> None:
    """Append rows under the folders of the layout, in each file by series and time.

    Rebalancing puts rows of a folder together for few files, and AQE splits a
    folder that is too large for one task, so a hot measurement is written by many.
    """
    _write_stored(to_stored(series, default_ts, layout), path, mode, rebalance, layout)


def _write_stored(stored: DataFrame, path: str, mode: str, rebalance: bool, layout: Layout) -> None:
    if rebalance:
        stored = stored.hint("rebalance", *layout.folders)
    # Spark sorts anew, by folders only, where a folder's name may be null (an empty name has the same folder).
    stored = stored.withColumn("measurement", F.coalesce("measurement", F.lit("")))
    writer = stored.sortWithinPartitions(*layout.folders, "series_id", "ts_ns").write.mode(mode)
    # The filter's size follows the number of distinct values in the row group.
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in ("series_id", *layout.tag_columns.values()):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    with write_sized(stored.sparkSession):
        writer.partitionBy(*layout.folders).parquet(path)


def query_series(
    spark: SparkSession,
    path: str,
    measurement: str | None = None,
    tags: Mapping[str, str] | None = None,
    fields: Sequence[str] | None = None,
    start_ns: int | None = None,
    end_ns: int | None = None,
    sql: str | None = None,
    view: str = "series",
    layout: Layout = PLAIN,
    whole_tags: bool = False,
) -> DataFrame:
    """Stored rows by measurement, tags and time range, or by SQL over view ``series``.

    Measurement and dates select folders; the time range and the layout's indexed tags
    are also pushed to the files. With ``whole_tags`` the tags are those of one series, no
    others beside them: its bucket is read only, and its id is pushed. Named ``fields``
    become columns (VALUE_T). Of a store with a commit list (``stream_write_series``) the
    committed folders are read.
    """
    stored = commits.read_committed(spark, path)
    stored = spark.read.parquet(path) if stored is None else stored
    if sql is not None:
        stored.createOrReplaceTempView(view)
        return spark.sql(sql)
    if measurement is not None:
        stored = stored.filter(F.col("measurement") == measurement)
    for bound, op in ((start_ns, ">="), (end_ns, "<")):
        if bound is not None:
            day = F.to_date(F.timestamp_seconds(F.lit(bound // 1_000_000_000)))
            if op == ">=":
                stored = stored.filter((F.col("date") >= day) & (F.col("ts_ns") >= bound))
            else:
                stored = stored.filter((F.col("date") <= day) & (F.col("ts_ns") < bound))
    for key, value in (tags or {}).items():
        if key in layout.tag_columns:
            stored = stored.filter(F.col(layout.tag_columns[key]) == value)
        stored = stored.filter(F.col("tags")[key] == value)
    if whole_tags:
        if measurement is None:
            raise ValueError("a series has a measurement")
        # A number at planning time, so that folders and files are chosen by it.
        cells = [F.lit(x) for pair in (tags or {}).items() for x in pair]
        wanted = series_id(F.lit(measurement), F.create_map(*cells) if cells else F.create_map().cast("map<string,string>"))
        one = spark.range(1).select(wanted.alias("id")).first()["id"]
        stored = stored.filter((F.col("series_id") == one) & (F.size("tags") == len(tags or {})))
        if layout.buckets > 1:
            stored = stored.filter(F.col("bucket") == one % layout.buckets)
    stored = stored.drop("series_id", "bucket", *layout.tag_columns.values())
    if fields is not None:
        stored = stored.select(
            "measurement", "tags", "ts_ns",
            *[F.try_element_at("fields", F.lit(f)).alias(f) for f in fields],
        )
    return stored


def latest_series(series: DataFrame, keys: Sequence[str | Column] = ("measurement",)) -> DataFrame:
    """Newest row of every series; combined before the shuffle, so no sort and no hot task.

    Of rows of the same newest time the one with the largest hash of all its columns is
    taken, so that every run returns the same one.
    """
    columns = series.columns
    plain = [F.sort_array(F.map_entries(c)) if t.startswith("map<") else F.col(c) for c, t in series.dtypes]
    grouped = series.groupBy(*[(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return grouped.agg(F.max_by(F.struct(*columns), F.struct("ts_ns", F.xxhash64(*plain))).alias("_r")).select("_r.*")


def first_attempt_ns(spark: SparkSession, path: str) -> int:
    """Time of the first call for this path, in nanoseconds; later calls return the same one."""
    spark.range(1).select(F.lit(time.time_ns()).alias("at")).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).agg(F.min("at")).first()[0]


def write_batch(series: DataFrame, path: str, batch_id: int, default_ts: Column, layout: Layout = PLAIN) -> None:
    """One batch as a folder of its own, valid to readers once it is complete.

    A batch that is already committed stays as it is, one that was left half written is
    overwritten: however often it is run, its rows are there once.
    """
    spark = series.sparkSession
    if any(e.first <= batch_id <= e.last for e in commits.entries(spark, path)):
        return
    folder = f"{path}/batch_id={batch_id}"
    stored = to_stored(series, default_ts, layout)
    _write_stored(stored, folder, "overwrite", True, layout)
    commits.commit(spark, path, commits.Entry(batch_id, batch_id, 0, folder, stored.schema.json()))


def compact_batches(spark: SparkSession, path: str, layout: Layout = PLAIN, fan_in: int = 16) -> list[commits.Entry]:
    """Merge the folders of small batches, by the same layout; the replaced ones stay until ``vacuum``."""
    return commits.compact(spark, path, lambda rows, folder: _write_stored(rows, folder, "overwrite", True, layout), fan_in)


def stream_write_series(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None, layout: Layout = PLAIN
) -> StreamingQuery:
    """Continuous form of ``write_series``.

    Every micro-batch is a ``write_batch``, so one that is run again after a failure leaves
    no duplicates and readers see it whole or not at all. Rows without a time take that
    of the batch's first attempt, which is kept beside the checkpoint, so that a further
    attempt writes equal rows. ``compact_batches`` may run beside the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        at = first_attempt_ns(batch.sparkSession, f"{checkpoint}-times/{batch_id}")
        write_batch(batch, path, batch_id, F.lit(at), layout)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**dict(trigger or {"availableNow": True})).start()


__all__ = [
    "Layout",
    "compact_batches",
    "first_attempt_ns",
    "latest_series",
    "query_series",
    "series_id",
    "stream_write_series",
    "to_stored",
    "write_batch",
    "write_series",
]
