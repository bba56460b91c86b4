"""Point preparation: sources, templates, scaling, quality, health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once
from tagflow.sources import messages as M

POINT_CONFIG = (
    "name string, addr string, type string, scale double, offset double, "
    "endian string, value string"
)
BAD_QUALITY = "read failed (quality=bad)"
NO_POINTS = "neither the message nor the catalog names a point"


def resolve_points(
    messages: DataFrame,
    catalog: DataFrame,
    device: str = "device",
    data_col: str = "data",
    keep: Sequence[str] = ("msg_id",),
) -> DataFrame:
    """Points a message asks for, else the configured list of its device.

    ``catalog`` has one row per (device, pos). Messages without points of their
    own join it by device, so a point list is never gathered into one row; a
    small catalog is broadcast by its measured size, a hot device is split by
    the adaptive skew join. Both empty gives one row with ``error``.
    """
    names = [c.split()[0] for c in POINT_CONFIG.split(", ")]
    members = ",".join(":".join(c.split()) for c in POINT_CONFIG.split(", "))
    asked = F.from_json(F.col(data_col), f"array<struct<{members}>>")
    kinds = {c.split()[0]: ("str",) if c.split()[1] == "string" else ("int", "num") for c in POINT_CONFIG.split(", ")}

    def readable(row: Column) -> Column:
        fits = F.lit(True)
        for name, allowed in kinds.items():
            fits = fits & F.coalesce(V.variant_kind(M.member(row, name)).isin("null", *allowed), F.lit(True))
        return fits

    data = F.col(data_col)
    rows = F.when(M.is_json_array(data) & M.is_whole_json(data), F.from_json(data, "array<map<string,variant>>"))
    readable_all = F.coalesce(F.forall("_rows", lambda r: F.coalesce(readable(r), F.lit(True))), F.lit(False))
    tried = compute_once(compute_once(messages, {"_rows": rows}), {"_own": F.when(readable_all, asked)}).drop("_rows")
    has_own = F.coalesce(F.size("_own") > 0, F.lit(False))
    own = tried.filter(has_own).select(
        *keep, device, F.lit("message").alias("source"), F.posexplode("_own").alias("pos", "_p")
    )
    own = own.select(*keep, device, "source", "pos", "_p.*", F.lit(None).cast("string").alias("error"))
    listed = tried.filter(~has_own).join(catalog.select(device, "pos", *names), device, "left")
    found = F.col("pos").isNotNull()
    return own.unionByName(
        listed.select(
            *keep,
            device,
            F.when(found, "catalog").otherwise("none").alias("source"),
            "pos",
            *names,
            F.when(~found, NO_POINTS).alias("error"),
        )
    )


def render_points(points: DataFrame, msg: Column, metadata: Column) -> DataFrame:
    """Fill templates in the text settings of every point; numbers pass through."""
    return points.withColumns(
        {c: X.render_column(F.col(c), msg, metadata) for c in ("name", "addr", "type", "endian", "value")}
    )


def scaled(raw: Column, scale: Column, offset: Column) -> Column:
    """``raw * scale + offset``; both 0 (or unset) leaves the value as it is."""
    scale = F.coalesce(scale, F.lit(0.0))
    offset = F.coalesce(offset, F.lit(0.0))
    return F.when((scale == 0) & (offset == 0), raw).otherwise(raw * scale + offset)


def scale_value(value: Column, scale: Column, offset: Column) -> Column:
    """Scaling of a VALUE_T: numbers and numeric text become doubles, the rest is kept."""
    scale = F.coalesce(scale, F.lit(0.0))
    offset = F.coalesce(offset, F.lit(0.0))
    raw = F.coalesce(V.as_double(value), X.parse_double(value["str"]))
    active = ((scale != 0) | (offset != 0)) & raw.isNotNull()
    return F.when(active, V.num(raw * scale + offset)).otherwise(value)


def apply_scale(
    points: DataFrame, catalog: DataFrame, on: Sequence[str] = ("device", "name")
) -> DataFrame:
    """Engineering conversion from the catalog's scale and offset.

    No forced broadcast: a small catalog is broadcast by its measured size, a
    large one is sort-merge joined with skew splitting.
    """
    factors = catalog.select(*on, F.col("scale").alias("_scale"), F.col("offset").alias("_offset"))
    return (
        points.join(factors, list(on), "left")
        .withColumn("value", scale_value(F.col("value"), F.col("_scale"), F.col("_offset")))
        .drop("_scale", "_offset")
    )


def unify_quality(
    protocol_points: DataFrame, scale: Column | None = None, offset: Column | None = None
) -> DataFrame:
    """Protocol results (quality good/bad) to the common point columns."""
    bad = F.coalesce(F.col("quality") == "bad", F.lit(False))
    value = F.col("value")
    if scale is not None or offset is not None:
        value = scale_value(value, scale if scale is not None else F.lit(0.0), offset if offset is not None else F.lit(0.0))
    return protocol_points.withColumns(
        {
            "value": F.when(bad, V.null()).otherwise(value),
            "ts_ns": F.when(bad, F.lit(0)).otherwise(F.col("ts_ns")).cast("bigint"),
            "error": F.when(bad, BAD_QUALITY),
        }
    ).drop("quality")


def has_error(error: Column) -> Column:
    """Blank and missing both mean good; the negation can be pushed to the files."""
    return error.isNotNull() & (error != "")


def split_quality(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad). Blank and missing error both mean good."""
    marked = points.withColumn("error", F.nullif(F.col("error"), F.lit("")))
    return marked.filter(F.col("error").isNull()), marked.filter(F.col("error").isNotNull())


def batch_health(points: DataFrame, keys: Sequence[str] = ("msg_id",), order: str = "pos") -> DataFrame:
    """Per batch: points, failures, last error and whether every point failed."""
    bad = has_error(F.col("error"))
    return points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(bad).alias("failures"),
        F.max_by(F.when(bad, F.col("error")), F.when(bad, F.col(order))).alias("last_error"),
        (F.count_if(bad) == F.count(F.lit(1))).alias("all_failed"),
    )


def classify_errors(points: DataFrame) -> DataFrame:
    """Adds ``error_class``: good, timeout or other."""
    bad = has_error(F.col("error"))
    return points.withColumn(
        "error_class",
        F.when(~bad, "good").when(X.is_timeout(F.col("error")), "timeout").otherwise("other"),
    )


def error_summary(points: DataFrame, keys: Sequence[str] = ("device",)) -> DataFrame:
    return classify_errors(points).groupBy(*keys, "error_class").agg(F.count(F.lit(1)).alias("points"))
