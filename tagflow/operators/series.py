"""Acquisition messages and point tables to time-series rows, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once, join_on, let
from tagflow.operators.points import has_error
from tagflow.schemas import VALUE_T, SeriesMapping
from tagflow.sources import messages as M

RESERVED_TIME = "timestamp"
RESERVED_WINDOW = "window_id"


def write_time_ns() -> Column:
    return (F.unix_micros(F.current_timestamp()) * 1000).cast("bigint")


def select_fields(fields: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Keep and rename map entries; no pairs keeps all, a later pair wins on its key."""
    if not pairs:
        return fields
    kept = [(key, source) for key, source in pairs if key != ""]
    if not kept:
        return F.when(fields.isNotNull(), F.map_filter(fields, lambda k, v: F.lit(False)))

    def chosen(whole: Column) -> Column:
        wanted = F.array(
            *[
                F.struct(F.lit(key).alias("key"), F.map_contains_key(whole, source).alias("found"),
                         F.try_element_at(whole, F.lit(source)).alias("value"))
                for key, source in kept
            ]
        )
        present = F.filter(wanted, lambda w: w["found"])
        return F.map_from_entries(
            F.transform(present, lambda w: F.struct(w["key"].alias("key"), w["value"].alias("value")))
        )

    # Bound once: the map may be a long expression, and every pair looks into it twice.
    return let(fields, chosen)


def render_tags(mapping: SeriesMapping, msg: Column, metadata: Column) -> Column:
    """Tag map from templates; blank keys are skipped, no tags at all is null."""
    if not mapping.tags:
        return F.lit(None).cast("map<string,string>")
    flat = [
        x
        for key, template in mapping.tags
        if key != ""
        for x in (F.lit(key), X.render_template(template, msg, metadata))
    ]
    return F.create_map(*flat).cast("map<string,string>")


def pivot_points(
    points: DataFrame,
    mapping: SeriesMapping,
    keys: Sequence[str] = ("msg_id",),
    metadata: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Point rows to one series row per batch, and the points of unmapped batches.

    Duplicates of a name are combined (last position wins) before rows of a batch
    meet, so only distinct names travel to the second step. The row's time is
    the newest time of all good points, selected or not.
    """
    metadata = metadata if metadata is not None else F.lit(None).cast("map<string,string>")
    good = points.filter(~has_error(F.col("error")) & (F.coalesce("name", F.lit("")) != ""))
    named = good.groupBy(*keys, "name").agg(
        F.max_by("value", "pos").alias("value"),
        F.max("ts_ns").alias("ts_ns"),
        F.any_value(metadata).alias("_meta"),
    )
    series = (
        named.groupBy(*keys)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("_all"),
            F.greatest(F.max("ts_ns"), F.lit(0)).cast("bigint").alias("ts_ns"),
            F.any_value("_meta").alias("_meta"),
        )
        .withColumn("fields", select_fields(F.col("_all"), mapping.fields))
        .filter(F.size("fields") > 0)
    )
    no_msg = F.lit(None).cast("string")
    series = series.select(
        *keys,
        X.render_template(mapping.measurement, no_msg, F.col("_meta")).alias("measurement"),
        render_tags(mapping, no_msg, F.col("_meta")).alias("tags"),
        "fields",
        "ts_ns",
    )
    # A batch is mapped if a good point of it is selected; that takes no pivot.
    sources = [source for key, source in mapping.fields if key != "" and source != ""]
    # Names first: only points of a listed name have their error read.
    selected = points.filter(F.col("name").isin(*sources) & ~has_error(F.col("error"))) if mapping.fields else good
    return series, join_on(points, selected.select(*keys).distinct(), keys, "left_anti")


def _point_row(rows: Column, mapping: SeriesMapping) -> tuple[Column, Column]:
    """(fields, ts_ns) of a point array, all inside the row."""
    good = F.filter(
        rows,
        lambda r: (F.coalesce(M.member_text(r, "error"), F.lit("")) == "")
        & (F.coalesce(M.member_text(r, "name"), F.lit("")) != ""),
    )
    entries = F.transform(
        good,
        lambda r: F.struct(
            M.member_text(r, "name").alias("key"), V.from_variant(M.member(r, "value")).alias("value")
        ),
    )
    newest = F.array_max(F.transform(good, lambda r: M.member_ns(r, "timestamp")))
    ts = F.greatest(F.coalesce(newest, F.lit(0)), F.lit(0)).cast("bigint")
    return select_fields(F.map_from_entries(entries), mapping.fields), ts


def _flat_rows(rows: Column, mapping: SeriesMapping, default_ts: Column) -> Column:
    """Array of (fields, ts_ns), one per object that keeps at least one field."""

    def one(row: Column) -> Column:
        return let(member_kind(row), lambda kind: timed(row, kind))

    def member_kind(row: Column) -> Column:
        return V.variant_kind(M.member(row, RESERVED_TIME))

    def timed(row: Column, kind: Column) -> Column:
        stamp = M.member(row, RESERVED_TIME)
        numeric = kind.isin("int", "num")
        fields = select_fields(F.transform_values(row, lambda _, v: V.from_variant(v)), mapping.fields)
        kept = F.map_filter(
            fields, lambda k, _: (k != RESERVED_WINDOW) & ~((k == RESERVED_TIME) & numeric)
        )
        ts = F.when(
            numeric,
            F.coalesce(
                F.when(kind == "int", F.try_variant_get(stamp, "$", "bigint")),
                F.try_variant_get(stamp, "$", "double").try_cast("bigint"),
            ),
        )
        return F.struct(kept.alias("fields"), F.coalesce(ts, default_ts).cast("bigint").alias("ts_ns"))

    made = F.transform(F.filter(rows, lambda r: r.isNotNull()), one)
    return F.filter(made, lambda s: F.size(s["fields"]) > 0)


def _is_series(rows: Column) -> Column:
    first = F.try_element_at(rows, F.lit(1))
    return F.coalesce(
        F.map_contains_key(first, "measurement") & F.map_contains_key(first, "fields"), F.lit(False)
    )


def flat_to_series(
    messages: DataFrame,
    mapping: SeriesMapping,
    default_ts: Column | None = None,
    data_col: str = "data",
    keep: Sequence[str] = ("msg_id",),
) -> DataFrame:
    """Flat object, or array of flat objects, to one series row per object.

    A numeric ``timestamp`` member is the row's time and no field; ``window_id``
    is never stored; an object left without fields gives no row.
    """
    default_ts = default_ts if default_ts is not None else write_time_ns()
    data, metadata = F.col(data_col), _metadata(messages)
    return (
        compute_once(messages, {"_rows": M.object_rows(data)})
        .filter(~_is_series(F.col("_rows")))
        .select(
            *keep,
            X.render_template(mapping.measurement, data, metadata).alias("measurement"),
            render_tags(mapping, data, metadata).alias("tags"),
            F.posexplode(_flat_rows(F.col("_rows"), mapping, default_ts)).alias("row", "_s"),
        )
        .select(*keep, "row", "measurement", "tags", "_s.fields", "_s.ts_ns")
    )


def _metadata(df: DataFrame) -> Column:
    return F.col("metadata") if "metadata" in df.columns else F.lit(None).cast("map<string,string>")


def dispatch_shape(
    messages: DataFrame,
    mapping: SeriesMapping,
    default_ts: Column | None = None,
    data_col: str = "data",
) -> tuple[DataFrame, DataFrame]:
    """Series rows of messages that can be mapped, and the other messages unchanged.

    Shapes are tried in order: point array whose first element is named, rows
    already in series form, flat objects. Everything happens inside the message
    row: no shuffle. Output columns: the message columns, ``shape``, ``row``, and the series.
    """
    if not mapping.enabled:
        return messages.limit(0).selectExpr(
            "*", "'' shape", "0 row", "'' measurement", "cast(null as map<string,string>) tags",
            f"cast(null as map<string,{VALUE_T}>) fields", "0L ts_ns",
        ), messages
    default_ts = default_ts if default_ts is not None else write_time_ns()
    data, metadata = F.col(data_col), _metadata(messages)
    rows = F.col("_rows")
    is_points = M.is_json_array(data) & M.holds_points(rows)
    shape = (
        F.when(is_points, "points")
        .when(rows.isNull() | (F.size(rows) == 0), "other")
        .when(_is_series(rows), "series")
        .otherwise("flat")
    )
    fields, ts = _point_row(rows, mapping)
    made = (
        F.when(
            F.col("shape") == "points",
            F.filter(
                F.array(F.struct(fields.alias("fields"), ts.alias("ts_ns"))),
                lambda s: F.size(s["fields"]) > 0,
            ),
        )
        .when(F.col("shape") == "flat", _flat_rows(rows, mapping, default_ts))
    )
    read = compute_once(compute_once(messages, {"_rows": M.object_rows(data)}), {"shape": shape})
    tried = compute_once(read, {"_made": made})
    has_rows = F.coalesce(F.size("_made") > 0, F.lit(False))
    mapped = (
        tried.filter(has_rows)
        .withColumn("measurement", X.render_template(mapping.measurement, data, metadata))
        .withColumn("tags", render_tags(mapping, data, metadata))
        .select(
            *messages.columns, "shape", "measurement", "tags", F.posexplode("_made").alias("row", "_s")
        )
        .select(*messages.columns, "shape", "row", "measurement", "tags", "_s.fields", "_s.ts_ns")
    )
    return mapped, tried.filter(~has_rows).select(*messages.columns)


def series_to_points(series: DataFrame, keep: Sequence[str] = ("measurement", "tags", "ts_ns")) -> DataFrame:
    """One row per field of a series row."""
    return series.select(*keep, F.explode("fields").alias("name", "value"))


def points_to_columns(
    points: DataFrame, names: Sequence[str], keys: Sequence[str] = ("msg_id",)
) -> DataFrame:
    """One column per listed point; the last good position of a name wins."""
    good = points.filter(~has_error(F.col("error")) & F.col("name").isin(*names))
    return good.groupBy(*keys).agg(
        *[
            F.max_by(
                F.when(F.col("name") == n, V.as_double(F.col("value"))),
                F.when(F.col("name") == n, F.col("pos")),
            ).alias(n)
            for n in names
        ]
    )


def valid_fields(series: DataFrame) -> DataFrame:
    """Drop null, NaN and infinite field values, and rows left without a field."""
    return series.withColumn(
        "fields", F.map_filter("fields", lambda _, v: V.is_storable(v))
    ).filter(F.size("fields") > 0)
