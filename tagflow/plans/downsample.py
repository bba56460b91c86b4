"""Acquisition points to one averaged series row per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions import values as V
from tagflow.operators import windows as W
from tagflow.operators.series import render_tags, select_fields
from tagflow.functions.text import render_template
from tagflow.schemas import SeriesMapping


def downsample(
    points: DataFrame, mapping: SeriesMapping, size: str, keys: Sequence[str], agg: str = "avg"
) -> DataFrame:
    """Window aggregate per point name, folded into one row stored at the window's end.

    ``keys`` name the device: equal point names of different devices stay apart, and a
    folded row holds the points of one device. ``points`` are good points with a numeric ``value`` and ``event_time``. The
    first aggregation combines before its shuffle; the fold that follows moves
    only one row per name and window.
    """
    fn = getattr(F, agg)
    per_point = W.window_end_ts(W.tumbling(points, size, [fn("value").alias("value")], (*keys, "name")))
    none = F.lit(None).cast("map<string,string>")
    folded = per_point.groupBy(*keys, "ts_ns").agg(
        F.map_from_entries(F.collect_list(F.struct("name", V.num(F.col("value"))))).alias("_all")
    )
    no_msg = F.lit(None).cast("string")
    return folded.select(
        *keys,
        render_template(mapping.measurement, no_msg, none).alias("measurement"),
        render_tags(mapping, no_msg, none).alias("tags"),
        select_fields(F.col("_all"), mapping.fields).alias("fields"),
        "ts_ns",
    ).filter(F.size("fields") > 0)
