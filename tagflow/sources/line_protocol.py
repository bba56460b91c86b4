"""Line protocol text: ``measurement,tag=v field=v timestamp``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions import values as V
from tagflow.functions.stages import compute_once, let
from tagflow.sources import records

# Characters are single or escaped by a backslash; possessive loops keep the
# patterns linear on long lines.
_NAME = r"(?:[^\\, \t]|\\.)++"
_KEY = r"(?:[^\\,= \t]|\\.)++"
_TAG = rf"{_KEY}={_KEY}"
_STRING = r'"(?:[^"\\]|\\.)*+"'
_PLAIN = r'[^", \t]++'
_FIELD = rf"{_KEY}=(?:{_STRING}|{_PLAIN})"
_LINE = rf"(?s)^({_NAME})((?:,{_TAG})*+)[ \t]++({_FIELD}(?:,{_FIELD})*+)(?:[ \t]++(-?\d+))?[ \t]*+\r?$"
# A line whose last value stays open; lines read from inside a value: one that goes on
# inside it or another one, and one that ends the record.
_OPEN = r'"(?:[^"\\]|\\.)*+\\?$'
_TO_QUOTE = r'^(?:[^"\\]|\\.)*+"'
_OPENS = rf"(?s)^(?!#){_NAME}(?:,{_TAG})*+[ \t]++(?:{_FIELD},)*+{_KEY}={_OPEN}"
_REOPENS = rf"(?s){_TO_QUOTE}(?:,{_FIELD})*+,{_KEY}={_OPEN}"
_CLOSES = rf"(?s){_TO_QUOTE}(?:,{_FIELD})*+(?:[ \t]++-?\d+)?[ \t]*+\r?$"


def _unescape(col: Column, chars: str) -> Column:
    return F.regexp_replace(col, rf"\\([{chars}])", "$1")


def _key(pair: Column) -> Column:
    return _unescape(F.regexp_extract(pair, rf"(?s)^({_KEY})=", 1), r",= ")


def _rest(pair: Column) -> Column:
    return F.regexp_extract(pair, rf"(?s)^{_KEY}=(.*)$", 1)


def field_value(raw: Column) -> Column:
    """Typed field: ``1i``/``1u`` whole, ``1.5`` number, ``t``/``false`` logical, quoted text."""
    body = F.regexp_replace(raw, r'(?s)^"(.*)"$', "$1")
    return (
        F.when(raw.startswith('"'), V.text(_unescape(body, r'"\\\\')))
        .when(raw.rlike(r"^-?\d+i$"), V.integer(F.regexp_replace(raw, "i$", "").try_cast("decimal(20,0)")))
        .when(raw.rlike(r"^\d+u$"), V.integer(F.regexp_replace(raw, "u$", "").try_cast("decimal(20,0)")))
        .when(raw.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), V.num(raw.try_cast("double")))
        .when(raw.isin("t", "T", "true", "True", "TRUE"), V.boolean(F.lit(True)))
        .when(raw.isin("f", "F", "false", "False", "FALSE"), V.boolean(F.lit(False)))
    )


def parse_lines(
    lines: DataFrame, line_col: str = "value", default_ts: Column | None = None, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(series, rejects) of one line per row.

    Blank lines and ``#`` comments give nothing. A line that cannot be read is a
    reject on its own; the other lines are kept. A line without a timestamp gets
    ``default_ts`` (the read time). Patterns run inside the JVM.
    """
    if default_ts is None:
        default_ts = (F.unix_micros(F.current_timestamp()) * 1000).cast("bigint")
    line = F.regexp_replace(F.col(line_col), r"^[ \t]+", "")
    used = lines.withColumn("_line", line).filter(
        (F.regexp_replace("_line", r"[\s]+", "") != "") & ~F.col("_line").startswith("#")
    )
    # One pass over the line; an unreadable line keeps a single part.
    parts = compute_once(
        used, {"_p": F.split(F.regexp_replace("_line", _LINE, "$1\u0000$2\u0000$3\u0000$4"), "\u0000", -1)}
    )
    ok = (F.size("_p") == 4) & ~F.col("_line").contains("\u0000")
    tag_pairs = F.regexp_extract_all(F.col("_p")[1], F.lit(rf"(?s),({_TAG})"), F.lit(1))
    field_pairs = F.regexp_extract_all(F.col("_p")[2], F.lit(rf"(?s)(?:^|\G,)({_FIELD})"), F.lit(1))
    tags = F.map_from_entries(
        F.transform(tag_pairs, lambda p: F.struct(_key(p).alias("k"), _unescape(_rest(p), ",= ").alias("v")))
    )
    fields = F.map_from_entries(
        F.transform(field_pairs, lambda p: F.struct(_key(p).alias("k"), let(_rest(p), field_value).alias("v")))
    )
    stamp = F.col("_p")[3]
    made = compute_once(
        parts,
        {
            "_ok": ok,
            "_m": F.col("_p")[0],
            "tags": F.when(ok, tags),
            "fields": F.when(ok, fields),
            "ts_ns": F.when(ok, F.when(stamp != "", stamp.try_cast("bigint")).otherwise(default_ts)),
        },
    )
    bad_value = F.exists(F.map_values("fields"), lambda v: v.isNull() | (v["kind"] == "null"))
    made = made.withColumn(
        "reason",
        F.when(~F.col("_ok"), "invalid line format")
        .when(bad_value, "invalid field value")
        .when(F.col("ts_ns").isNull(), "timestamp out of range"),
    )
    series = made.filter(F.col("reason").isNull()).select(
        *keep, _unescape(F.col("_m"), ", ").alias("measurement"), "tags", "fields", "ts_ns"
    )
    return series, made.filter(F.col("reason").isNotNull()).select(*keep, F.col(line_col).alias("line"), "reason")


def read_line_protocol(
    source: str | DataFrame,
    spark: SparkSession | None = None,
    default_ts: Column | None = None,
    line_ends_in_values: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(series, rejects) from text files or from a frame with a ``value`` column.

    A frame holds one record a row. In files a quoted value may hold line ends, also where
    they fall in different blocks (``records``); this moves the lines once. For files that
    are known to have none, ``line_ends_in_values=False`` reads each line where it lies.
    """
    if isinstance(source, DataFrame):
        return parse_lines(source, default_ts=default_ts)
    if not line_ends_in_values:
        return parse_lines(spark.read.text(source), default_ts=default_ts)
    return parse_lines(joined_lines(records.file_lines(spark, source)), default_ts=default_ts)


def joined_lines(lines: DataFrame) -> DataFrame:
    """``value``: one record a row, of lines as ``records.file_lines`` gives them."""
    value = F.col("value")
    quoted = value.contains('"')
    opens = quoted & F.regexp_replace(value, r"^[ \t]+", "").rlike(_OPENS)
    # Every line without a quote goes on; so does one whose quotes are all escaped.
    goes_on = ~quoted | ~value.rlike(rf"(?s){_TO_QUOTE}") | value.rlike(_REOPENS)
    return records.whole_records(lines, opens, goes_on, quoted & value.rlike(_CLOSES))


def _escape(col: Column, chars: str) -> Column:
    return F.regexp_replace(col, rf"([{chars}])", r"\\$1")


def field_text(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.regexp_replace(F.coalesce(value["str"], value["json"]), r'(["\\])', r"\\$1"), F.lit('"'))
    unsigned = value["int"] > F.lit("9223372036854775807").cast("decimal(20,0)")
    return (
        F.when(value["kind"] == "num", value["num"].cast("string"))
        .when(value["kind"] == "int", F.concat(value["int"].cast("string"), F.when(unsigned, "u").otherwise("i")))
        .when(value["kind"] == "bool", value["bool"].cast("string"))
        .when(value["kind"].isin("str", "json"), quoted)
    )


def to_lines(series: DataFrame) -> DataFrame:
    """Series rows as one text line each; keys are sorted, unstorable fields left out."""
    tag_entries = F.array_sort(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))))
    tags = F.array_join(
        F.transform(
            F.filter(tag_entries, lambda e: e["value"] != ""),
            lambda e: F.concat(F.lit(","), _escape(e["key"], ",= "), F.lit("="), _escape(e["value"], ",= ")),
        ),
        "",
    )
    names = F.array_sort(F.map_keys("fields"))
    cells = F.transform(
        F.filter(names, lambda n: V.is_storable(F.col("fields")[n])),
        lambda n: F.concat(_escape(n, ",= "), F.lit("="), field_text(F.col("fields")[n])),
    )
    stamp = F.when(F.col("ts_ns") != 0, F.concat(F.lit(" "), F.col("ts_ns").cast("string"))).otherwise(F.lit(""))
    made = series.withColumn("_cells", cells).filter(F.size("_cells") > 0)
    return made.select(
        F.concat(_escape(F.col("measurement"), ", "), tags, F.lit(" "), F.array_join("_cells", ","), stamp).alias("value")
    )


def write_line_protocol(series: DataFrame, path: str, mode: str = "append") -> None:
    to_lines(series).write.mode(mode).text(path)
