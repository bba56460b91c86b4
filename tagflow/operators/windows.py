"""Window aggregation, change detection, per-row transforms."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.text import parse_duration_ms
from tagflow.functions.values import as_double
from tagflow.operators.ordered import SLICE, Ordered, row_number
from tagflow.operators.points import has_error

# Nanoseconds per unit (fixed values).
UNIT_FACTOR_NS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000}

# No data lies at or behind this time; a stream's row at the mark ends its input. The mark
# lies far enough behind for watermarks of up to a month of delay.
END_NS = 1 << 62
MARK_NS = END_NS + 31 * 86_400 * 1_000_000_000


def before_end(stream: DataFrame, column: str) -> DataFrame:
    """Without the mark that ends the input; called behind the watermark, which it moves.

    Spark moves other conditions ahead of the watermark unless they name the event time;
    the mark has to pass those.
    """
    return stream.filter(F.col(column) < F.timestamp_micros(F.lit(END_NS // 1000).cast("bigint")))


def length_ms(text: str) -> int:
    """Length of a window; an error if it is none."""
    ms = parse_duration_ms(text)
    if ms is None or ms <= 0:
        raise ValueError(f"invalid window length {text!r}")
    return ms


def interval(text: str) -> str:
    """``1m`` / ``1h30m`` / ``500ms`` to an interval Spark's windows accept."""
    return f"{length_ms(text)} milliseconds"


def event_time(df: DataFrame, col: str = "ts_ns", unit: str = "ns", watermark: str | None = None) -> DataFrame:
    """Adds ``event_time`` from a data column in the stated unit.

    With ``watermark`` (a duration) rows later than that are dropped by streaming
    aggregations; batch plans ignore it. A row at ``MARK_NS`` then closes all windows.
    """
    if unit not in UNIT_FACTOR_NS:
        raise ValueError(f"unknown time unit {unit!r}")
    if unit == "ns":
        micros = F.call_function("div", F.col(col) - F.pmod(F.col(col), F.lit(1000)), F.lit(1000).cast("bigint"))
    else:
        micros = F.col(col) * F.lit(UNIT_FACTOR_NS[unit] // 1000)
    out = df.withColumn("event_time", F.timestamp_micros(micros.cast("bigint")))
    return before_end(out.withWatermark("event_time", interval(watermark)), "event_time") if watermark else out


def numeric_points(points: DataFrame) -> DataFrame:
    """Good points with ``value`` as double: the input of the aggregations."""
    good = points.filter(~has_error(F.col("error")))
    if dict(good.dtypes)["value"].startswith("struct"):
        good = good.withColumn("value", as_double(F.col("value")))
    return good


def window_end_ns(window: str = "window") -> Column:
    """Window end as nanoseconds: the stored time of an aggregate."""
    return (F.unix_micros(F.col(window)["end"]) * 1000).cast("bigint")


def window_start_ns(window: str = "window") -> Column:
    return (F.unix_micros(F.col(window)["start"]) * 1000).cast("bigint")


def window_end_ts(agg: DataFrame, window: str = "window") -> DataFrame:
    """Replace the window column by the ``ts_ns`` to store the aggregate at."""
    return agg.withColumn("ts_ns", window_end_ns(window)).drop(window)


def tumbling(points: DataFrame, size: str, aggs: Sequence[Column], keys: Sequence[str] = ("name",)) -> DataFrame:
    """Aggregates of good points per key and fixed, epoch-aligned window."""
    return points.groupBy(*keys, F.window("event_time", interval(size))).agg(*aggs)


# Per kind of measure: what a pane keeps, and what a window makes of it.
_PARTS: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "count": (("count",), lambda n: F.sum(n)),
    "sum": (("sum",), lambda s: F.sum(s)),
    "min": (("min",), lambda v: F.min(v)),
    "max": (("max",), lambda v: F.max(v)),
    "avg": (("sum", "count"), lambda s, n: F.try_divide(F.sum(s).cast("double"), F.sum(n))),
}


def sliding(
    points: DataFrame, size: str, slide: str, measures: Mapping[str, tuple[str, Column]], keys: Sequence[str] = ("name",)
) -> DataFrame:
    """Measures (name: kind and column; kinds count, sum, avg, min, max) per key and overlapping window.

    Rows are combined once, into panes as long as the greatest common divisor of size and
    slide; windows are made of whole panes, so only panes are listed under every window
    they belong to, never rows.
    """
    length, step = (length_ms(x) * 1000 for x in (size, slide))
    pane = math.gcd(length, step)
    at = F.unix_micros("event_time")
    parts = {f"_{name}_{i}": (part, value) for name, (kind, value) in measures.items() for i, part in enumerate(_PARTS[kind][0])}
    panes = points.groupBy(*keys, (at - F.pmod(at, F.lit(pane))).alias("_pane")).agg(
        *[getattr(F, part)(value).alias(n) for n, (part, value) in parts.items()]
    )
    newest = F.col("_pane") - F.pmod("_pane", F.lit(step))
    opened = F.sequence(newest - (math.ceil(length / step) - 1) * step, newest, F.lit(step).cast("bigint"))
    rows = panes.withColumn("_start", F.explode(opened)).filter(F.col("_start") + length > F.col("_pane"))
    window = F.struct(F.timestamp_micros("_start").alias("start"), F.timestamp_micros(F.col("_start") + length).alias("end"))
    made = [
        _PARTS[kind][1](*[F.col(f"_{name}_{i}") for i in range(len(_PARTS[kind][0]))]).alias(name)
        for name, (kind, _) in measures.items()
    ]
    return rows.groupBy(*keys, window.alias("window")).agg(*made)


def sliding_stream(
    points: DataFrame, size: str, slide: str, aggs: Sequence[Column], keys: Sequence[str] = ("name",)
) -> DataFrame:
    """Aggregates per key and overlapping window for streams, which keep each window's state."""
    return points.groupBy(*keys, F.window("event_time", interval(size), interval(slide))).agg(*aggs)


def session_stream(points: DataFrame, gap: str, aggs: Sequence[Column], keys: Sequence[str] = ("name",)) -> DataFrame:
    """Gap-delimited windows for streams (Spark merges sessions in its state store)."""
    return points.groupBy(*keys, F.session_window("event_time", interval(gap)).alias("window")).agg(*aggs)


def session(
    points: DataFrame,
    gap: str,
    aggs: Sequence[Column],
    keys: Sequence[str] = ("name",),
    order: Sequence[str] = ("event_time",),
    width: str | int = SLICE,
) -> DataFrame:
    """Gap-delimited windows of a batch: a row opens a session when the row
    before it is at least ``gap`` away; the window ends ``gap`` after the last row.

    Session numbers come from a running sum over slices (``ordered``), and the
    aggregation combines before its shuffle, so neither a hot key nor a giant
    session lands in one task.
    """
    gap_us = parse_duration_ms(gap) * 1000
    at = F.unix_micros("event_time")
    rows = Ordered.of(points, keys, order, width)
    rows = rows.add(_before=rows.previous(F.unix_micros("event_time")))
    opens = F.when(F.col("_before").isNull() | (at - F.col("_before") >= gap_us), 1).otherwise(0)
    rows = rows.with_column("_opens", opens.cast("bigint"))
    numbered = rows.add(_session=rows.total(F.col("_opens"), peers=True))
    return (
        numbered.df.groupBy(*keys, "_session")
        .agg(
            F.struct(
                F.min("event_time").alias("start"),
                F.timestamp_micros(F.max(at) + gap_us).alias("end"),
            ).alias("window"),
            *aggs,
        )
        .drop("_session")
    )


def count_window(
    points: DataFrame,
    n: int,
    aggs: Sequence[Column],
    keys: Sequence[str] = ("name",),
    order: Sequence[str] = ("ts_ns", "seq"),
    width: str | int = SLICE,
) -> DataFrame:
    """Aggregates over every n consecutive rows of a key; ``complete`` is false for a shorter tail."""
    rows = Ordered.of(points, keys, order, width)
    rows = rows.add(_rn=row_number(rows)).df
    number = F.call_function("div", F.col("_rn") - 1, F.lit(n).cast("bigint")).alias("window_no")
    return (
        rows.groupBy(*keys, number)
        .agg(*aggs, (F.count(F.lit(1)) == n).alias("complete"))
    )


def cross_point(points: DataFrame, size: str, exprs: Mapping[str, Column], names: Sequence[str],
                keys: Sequence[str] = (), agg: str = "avg") -> DataFrame:
    """Arithmetic over several points of a window, e.g. average voltage times average current.

    Each listed point becomes a conditional aggregate named after it; ``exprs``
    are computed from those names. Works on streams, which cannot pivot.
    """
    fn = getattr(F, agg)
    listed = F.col("name").isin(*names)
    if points.isStreaming:
        # Names the event time, so that it stays behind the watermark, which has to see the mark.
        listed = F.when(F.col("event_time").isNotNull(), listed)
    wide = (
        points.filter(listed)
        .groupBy(*keys, F.window("event_time", interval(size)))
        .agg(*[fn(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    )
    return wide.select(*keys, "window", *[e.alias(k) for k, e in exprs.items()])


def transform(df: DataFrame, where: str | None, select: Sequence[str]) -> DataFrame:
    """Per-row filter and computed columns given as SQL expressions."""
    kept = df.filter(where) if where else df
    return kept.selectExpr(*select)


def changes(
    points: DataFrame,
    keys: Sequence[str] = ("name",),
    order: Sequence[str] = ("ts_ns", "seq"),
    value: str = "value",
    epsilon: float = 0.0,
    width: str | int = SLICE,
) -> DataFrame:
    """Rows whose value moved by more than ``epsilon`` since the key's previous row.

    The first row of a key counts as a change; so does a step to or from null.
    Adds ``previous``.
    """
    now = F.col(value)
    rows = Ordered.of(points, keys, order, width)
    rows = rows.add(_prev=rows.previous(F.struct(now.alias("v")))).df
    before = F.col("_prev.v")
    if dict(points.dtypes)[value] in ("double", "float", "int", "bigint"):
        moved = F.abs(now - before) > epsilon
    else:
        moved = now != before
    moved = F.when(now.isNull() | before.isNull(), ~now.eqNullSafe(before)).otherwise(moved)
    return (
        rows.withColumn("previous", before)
        .filter(F.col("_prev").isNull() | moved)
        .drop("_prev")
    )
