"""Acquisition messages and series messages held as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once, let

_OBJECT_ROWS = "array<map<string,variant>>"


def is_json_array(data: Column) -> Column:
    return F.coalesce(X.strip(data).startswith("["), F.lit(False))


def is_whole_json(data: Column) -> Column:
    """True when the text is one JSON value and nothing else.

    Spark's parsers stop at the end of the first value; text behind it only shows once
    the value is wrapped, and no text can be cut short of both wrappings.
    """
    wrapped = lambda a, b: F.try_parse_json(F.concat(F.lit(a), data, F.lit(b))).isNotNull()
    return F.coalesce(wrapped("[", "]") & wrapped('{"v":', "}"), F.lit(False))


def object_rows(data: Column) -> Column:
    """JSON object or array of objects as an array of maps; null for anything else."""
    rows = F.from_json(data, _OBJECT_ROWS)
    single = let(F.from_json(data, "map<string,variant>"), lambda o: F.when(o.isNotNull(), F.array(o)))
    return F.when(is_whole_json(data), F.when(is_json_array(data), rows).otherwise(single))


def member(row: Column, key: str) -> Column:
    """Member of an object row; null when it is missing."""
    return F.try_element_at(row, F.lit(key))


def member_text(row: Column, key: str) -> Column:
    return F.try_variant_get(member(row, key), "$", "string")


def member_ns(row: Column, key: str) -> Column:
    return F.try_variant_get(member(row, key), "$", "bigint")


def holds_points(rows: Column) -> Column:
    """True when every element can be read as a point and the first one has a name."""

    first = F.try_element_at(rows, F.lit(1))
    named = F.coalesce(member_text(first, "name"), F.lit("")) != ""
    return F.coalesce(rows.isNotNull() & named & _readable_points(rows), F.lit(False))


def _readable_points(rows: Column) -> Column:
    """True when the members of every element have the kinds of a point."""

    def readable(row: Column) -> Column:
        return (
            V.is_kind(member(row, "name"), "null", "str")
            & V.is_kind(member(row, "error"), "null", "str")
            & V.is_kind(member(row, "timestamp"), "null", "int")
        )

    return F.forall(rows, lambda r: F.coalesce(readable(r), F.lit(True)))


def read_points(df: DataFrame, data_col: str = "data", keep: tuple[str, ...] = ("msg_id",)) -> DataFrame:
    """One row per element of the acquisition array, with its position.

    Rows come straight out of the message, so there is no shuffle. A message that
    cannot be read as points gives no rows; ``unread_points`` lists those.
    """
    row = F.col("_row")
    checked = _checked_points(df, data_col).filter(F.col("reason").isNull())
    return checked.select(*keep, F.posexplode("_rows").alias("pos", "_row")).select(
        *keep,
        "pos",
        member_text(row, "name").alias("name"),
        V.from_variant(member(row, "value")).alias("value"),
        F.coalesce(member_ns(row, "timestamp"), F.lit(0)).cast("bigint").alias("ts_ns"),
        F.nullif(member_text(row, "error"), F.lit("")).alias("error"),
    )


def _checked_points(df: DataFrame, data_col: str) -> DataFrame:
    data = F.col(data_col)
    rows = F.when(is_json_array(data) & is_whole_json(data), F.from_json(data, _OBJECT_ROWS))
    reason = F.when(F.col("_rows").isNull(), "not readable as a point array").when(
        ~F.coalesce(_readable_points(F.col("_rows")), F.lit(False)), "wrong member type"
    )
    return compute_once(compute_once(df, {"_rows": rows}), {"reason": reason})


def unread_points(df: DataFrame, data_col: str = "data", keep: tuple[str, ...] = ("msg_id",)) -> DataFrame:
    """Messages that ``read_points`` gives no rows for, with the reason; an empty array is none."""
    return _checked_points(df, data_col).filter(F.col("reason").isNotNull()).select(*keep, data_col, "reason")


def read_series_json(
    df: DataFrame, data_col: str = "data", keep: tuple[str, ...] = ("msg_id",)
) -> tuple[DataFrame, DataFrame]:
    """Series messages (array or single object) to rows, and rejects with a reason."""
    data = F.col(data_col)
    parsed = object_rows(data)

    def readable(row: Column) -> Column:
        return (
            V.variant_kind(member(row, "measurement")).isin("null", "str")
            & V.variant_kind(member(row, "timestamp")).isin("null", "int")
            & F.coalesce(
                F.forall(
                    F.map_values(F.try_variant_get(member(row, "tags"), "$", "map<string,variant>")),
                    lambda v: V.variant_kind(v).isin("str", "null"),
                ),
                member(row, "tags").isNull() | F.is_variant_null(member(row, "tags")),
            )
            & (
                member(row, "fields").isNull()
                | F.is_variant_null(member(row, "fields"))
                | F.try_variant_get(member(row, "fields"), "$", "map<string,variant>").isNotNull()
            )
        )

    reason = (
        F.when(F.col("_rows").isNull(), "not readable as series JSON")
        .when(F.size("_rows") == 0, "no points in message")
        .when(~F.forall("_rows", lambda r: F.coalesce(readable(r), F.lit(True))), "wrong member type")
    )
    checked = compute_once(compute_once(df, {"_rows": parsed}), {"reason": reason})
    row = F.col("_row")
    fields = F.try_variant_get(member(row, "fields"), "$", "map<string,variant>")
    series = (
        checked.filter(F.col("reason").isNull())
        .select(*keep, F.posexplode("_rows").alias("pos", "_row"))
        .select(
            *keep,
            "pos",
            F.coalesce(member_text(row, "measurement"), F.lit("")).alias("measurement"),
            F.transform_values(
                F.try_variant_get(member(row, "tags"), "$", "map<string,string>"),
                lambda _, v: F.coalesce(v, F.lit("")),
            ).alias("tags"),
            F.transform_values(fields, lambda _, v: V.from_variant(v)).alias("fields"),
            F.coalesce(member_ns(row, "timestamp"), F.lit(0)).cast("bigint").alias("ts_ns"),
        )
    )
    rejects = checked.filter(F.col("reason").isNotNull()).select(*keep, data_col, "reason")
    return series, rejects
