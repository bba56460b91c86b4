"""Text functions: templates, booleans, durations, numbers, addresses."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagflow.functions.stages import let

PLACEHOLDER = r"\$\{\s*(msg|metadata)\.([^{}]+?)\s*\}"

# Duration units in nanoseconds (fixed values).
UNIT_NS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}
_DURATION_PART = r"(\d+\.?\d*|\.\d+)(ns|us|µs|μs|ms|s|m|h)"
_MAX_NS = (1 << 63) - 1

_DECIMAL_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SPECIAL_NUMBER = r"(?i)^([+-]?(inf|infinity)|nan)$"
_HEX_NUMBER = r"(?i)^[+-]?0x([0-9a-f]+\.?[0-9a-f]*|\.[0-9a-f]+)p[+-]?\d+$"


WHITE_SPACE = " \t\n\r\u000b\u000c\u0085\u00a0"


def strip(col: Column) -> Column:
    """Cut white space of every kind from both ends."""
    return F.btrim(col, F.lit(WHITE_SPACE))


# -- templates ---------------------------------------------------------------


def _lookup(scope: str, key: str, msg: Column, metadata: Column) -> Column:
    found = F.get_json_object(msg, f"$.{key}") if scope == "msg" else F.try_element_at(metadata, F.lit(key))
    return F.coalesce(found, F.lit(""))


def render_template(template: str, msg: Column, metadata: Column) -> Column:
    """Fill a fixed template; it is split once here, so rows only concatenate.

    A missing key gives an empty string. Text without placeholders, and text
    whose placeholders cannot be read, comes back unchanged.
    """
    if "${" not in template or "${" in re.sub(PLACEHOLDER, "", template):
        return F.lit(template)
    parts: list[Column] = []
    at = 0
    for m in re.finditer(PLACEHOLDER, template):
        if m.start() > at:
            parts.append(F.lit(template[at:m.start()]))
        parts.append(_lookup(m.group(1), m.group(2), msg, metadata))
        at = m.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def render_column(template: Column, msg: Column, metadata: Column) -> Column:
    """As ``render_template`` for templates that differ from row to row."""
    whole = F.lit(PLACEHOLDER)
    scopes = F.regexp_extract_all(template, whole, F.lit(1))
    names = F.regexp_extract_all(template, whole, F.lit(2))
    filled = F.transform(
        F.arrays_zip(scopes.alias("scope"), names.alias("name")),
        lambda p: F.coalesce(
            F.when(p["scope"] == "msg", F.call_function("get_json_object", msg, F.concat(F.lit("$."), p["name"])))
            .otherwise(F.try_element_at(metadata, p["name"])),
            F.lit(""),
        ),
    )
    fixed = F.split(template, PLACEHOLDER, -1)
    woven = F.zip_with(fixed, filled, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    readable = ~F.regexp_replace(template, PLACEHOLDER, "").contains("${")
    return F.when(template.contains("${") & readable, F.array_join(woven, "")).otherwise(template)


# -- numbers, booleans, durations ----------------------------------------------


def parse_double(col: Column) -> Column:
    """Decimal text (also inf and nan) to double; null when it is not a number.

    ``try_cast`` alone would also take Java suffixes such as ``1.0d``.
    """

    def read(text: Column) -> Column:
        plain = let(
            F.when(text.rlike(_DECIMAL_NUMBER), text).try_cast("double"),
            lambda n: F.when(F.abs(n) < float("inf"), n),
        )
        special = F.when(
            text.rlike(_SPECIAL_NUMBER),
            F.when(F.lower(text) == "nan", F.lit(float("nan")))
            .when(text.startswith("-"), F.lit(float("-inf")))
            .otherwise(F.lit(float("inf"))),
        )
        return F.coalesce(plain, special)

    return let(col, read)


def to_bool(col: Column) -> Column:
    """true / 1 / any non-zero number is true; blank, 0, null and other text false."""

    def read(low: Column) -> Column:
        mantissa = F.regexp_extract(low, r"0x([0-9a-f.]+)p", 1)
        number = let(parse_double(low), lambda n: F.coalesce(F.isnan(n) | (n != 0), F.lit(False)))
        return (
            F.when(low.isin("true", "1"), True)
            .when(low.isNull() | low.isin("", "false", "0", "null"), False)
            .when(low.rlike(_HEX_NUMBER), mantissa.rlike("[1-9a-f]"))
            .otherwise(number)
        )

    return let(F.lower(strip(col)), read)


def duration_ms(col: Column) -> Column:
    """``1h30m``, ``1.5s``, ``-300us``, bare ``0``: whole milliseconds, else null."""
    units = F.expr("map(" + ", ".join(f"'{u}', cast({n} as decimal(14,0))" for u, n in UNIT_NS.items()) + ")")
    zero = F.lit(0).cast("decimal(38,0)")

    def part_ns(number: Column, unit: Column) -> Column:
        exact = F.concat(F.lit("0"), number).try_cast("decimal(28,9)")
        return F.floor(F.try_multiply(exact, units[unit])).try_cast("decimal(38,0)")

    def body_ms(body: Column) -> Column:
        numbers = F.regexp_extract_all(body, F.lit(_DURATION_PART), F.lit(1))
        names = F.regexp_extract_all(body, F.lit(_DURATION_PART), F.lit(2))
        total = F.aggregate(
            F.zip_with(numbers, names, part_ns),
            zero,
            lambda acc, x: F.try_add(acc, x).try_cast("decimal(38,0)"),
        )
        whole = let(
            total,
            lambda t: F.when(t <= F.lit(_MAX_NS).cast("decimal(38,0)"), t.cast("bigint")),
        )
        ms = F.call_function("div", whole, F.lit(1_000_000).cast("bigint"))
        return F.when(body == "0", F.lit(0).cast("bigint")).when(
            body.rlike(f"^({_DURATION_PART})+$"), ms
        )

    def read(text: Column) -> Column:
        magnitude = let(F.regexp_replace(text, "^[+-]", ""), body_ms)
        return magnitude * F.when(text.startswith("-"), -1).otherwise(1)

    return let(strip(col), read)


def parse_duration_ms(s: str) -> int | None:
    """Plan-time form of ``duration_ms`` for fixed settings."""
    s = s.strip()
    body = s[1:] if s[:1] in "+-" and s else s
    if body == "0":
        return 0
    if not re.fullmatch(f"({_DURATION_PART})+", body):
        return None
    total = sum(int(Decimal(n) * UNIT_NS[u]) for n, u in re.findall(_DURATION_PART, body))
    if total > _MAX_NS:
        return None
    return (-1 if s.startswith("-") else 1) * (total // 1_000_000)


def parse_integer(col: Column) -> Column:
    """Integer text with optional sign and 0x / 0o / 0b / leading-0 base to decimal(38,0)."""
    plain = F.lower(F.replace(col, F.lit("_"), F.lit("")))
    # Underscores may only stand between digits of a prefixed number.
    spaced = ~col.contains("_") | col.rlike(r"(?i)^[+-]?0[xob]?(_?[0-9a-f])+$")
    digits = lambda pattern: F.nullif(F.regexp_extract(plain, pattern, 1), F.lit(""))
    number = F.coalesce(
        digits(r"^[+-]?(0|[1-9]\d*)$"),
        F.conv(digits(r"^[+-]?0x0*([0-9a-f]{1,16})$"), 16, 10),
        F.conv(digits(r"^[+-]?0b0*([01]{1,64})$"), 2, 10),
        F.conv(digits(r"^[+-]?0o?0*([0-7]{1,21})$"), 8, 10),
    ).try_cast("decimal(38,0)")
    return F.when(spaced, F.when(plain.startswith("-"), -number).otherwise(number))


def parse_bool_text(col: Column) -> Column:
    """1, t, T, TRUE, true, True and their opposites, or any decimal integer."""

    def read(s: Column) -> Column:
        return (
            F.when(s.isin("1", "t", "T", "TRUE", "true", "True"), True)
            .when(s.isin("0", "f", "F", "FALSE", "false", "False"), False)
            .when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint") != 0)
        )

    return let(strip(col), read)


def is_timeout(error: Column) -> Column:
    low = F.lower(error)
    return F.coalesce(low.contains("timeout") | low.contains("deadline exceeded"), F.lit(False))


def normalize_oid(oid: Column) -> Column:
    """OID without outer blanks and one leading dot, so that both writings are equal."""
    bare = strip(oid)
    return F.when(bare.startswith("."), F.substring(bare, 2, 1 << 30)).otherwise(bare)


def split_server(server: Column, default_port: int) -> tuple[Column, Column]:
    """(host, port) of ``host``, ``host:port`` or ``[v6]:port``; null port when invalid."""
    s = strip(server)
    plain, bracket = r"^([^:\[\]]*):([^:\[\]]*)$", r"^\[([^\[\]]*)\]:([^:\[\]]*)$"
    text = (
        F.when(s.rlike(plain), F.regexp_extract(s, plain, 2))
        .when(s.rlike(bracket), F.regexp_extract(s, bracket, 2))
    )
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    host = (
        F.when(s.rlike(plain), F.regexp_extract(s, plain, 1))
        .when(s.rlike(bracket), F.regexp_extract(s, bracket, 1))
        .otherwise(s)
    )
    port = F.when(s == "", F.lit(None).cast("int")).when(
        text.isNull(), F.lit(default_port)
    ).when(number.between(1, 65535), number)
    return F.when(port.isNotNull(), host), port
