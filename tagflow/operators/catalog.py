"""Point catalogs and setpoints: canonical names, checks, typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once

S7_TYPES = ("BOOL", "BYTE", "INT", "WORD", "DINT", "DWORD", "REAL", "LREAL", "STRING")

# Object types and properties by their hyphenated name, with short forms (fixed values).
OBJECT_TYPES = {
    "analog-input": (0, "ai"),
    "analog-output": (1, "ao"),
    "analog-value": (2, "av"),
    "binary-input": (3, "bi"),
    "binary-output": (4, "bo"),
    "binary-value": (5, "bv"),
    "device": (8, "dev"),
    "multi-state-input": (13, "msi"),
    "multi-state-output": (14, "mso"),
    "multi-state-value": (19, "msv"),
}
PROPERTIES = {
    "description": (28, "desc"),
    "object-identifier": (75, None),
    "object-list": (76, None),
    "object-name": (77, "name"),
    "object-type": (79, None),
    "present-value": (85, "pv"),
    "priority-array": (87, None),
    "relinquish-default": (104, None),
    "units": (117, "unit"),
}


def alias_codes(names: dict[str, tuple[int, str | None]]) -> dict[str, int]:
    """Every accepted spelling: hyphenated, joined, short, and ``multistate-x``."""
    out = {}
    for name, (code, short) in names.items():
        spellings = {name, name.replace("-", ""), short, name.replace("multi-state-", "multistate-")}
        out.update({s: code for s in spellings if s})
    return out


def _alias(token: Column, names: dict[str, int], limit: int) -> Column:
    low = F.lower(X.strip(token))
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    number = F.when(low.rlike(r"^\d+$"), low.try_cast("decimal(20,0)"))
    number = F.when(number <= limit, number.cast("bigint"))
    return F.coalesce(F.try_element_at(table, low).cast("bigint"), number)


def object_type_code(token: Column) -> Column:
    return _alias(token, alias_codes(OBJECT_TYPES), 0xFFFF)


def property_code(token: Column) -> Column:
    return _alias(token, alias_codes(PROPERTIES), 0xFFFFFFFF)


def s7_address(area: Column, db: Column, addr: Column, kind: Column, bit: Column) -> Column:
    """``DB1.4``, ``DB1.4.2`` for bits, ``M10``, ``M10.3`` for bits."""
    area = F.upper(F.trim(area))
    base = F.when(area == "DB", F.format_string("DB%d.%d", db, addr)).otherwise(
        F.concat(area, addr.cast("string"))
    )
    is_bit = F.upper(kind) == "BOOL"
    return F.when(is_bit, F.concat(base, F.lit("."), F.coalesce(bit, F.lit(0)).cast("string"))).otherwise(base)


def normalize_catalog(catalog: DataFrame, default_port: int = 502) -> tuple[DataFrame, DataFrame]:
    """(normalized, rejects) of a catalog with ``protocol`` per row.

    Columns used: protocol (s7, bacnet, other), type, area, db, addr, bit,
    object_type, property, server. Adds canonical ``type``, ``address``,
    ``object_code``, ``property_code``, ``host``, ``port``.
    """
    protocol = F.lower(F.trim("protocol"))
    area = F.upper(F.trim("area"))
    kind = F.upper(X.strip(F.col("type")))
    host, port = X.split_server(F.col("server"), default_port)
    is_s7, is_bacnet = protocol == "s7", protocol == "bacnet"
    made = catalog.withColumns(
        {
            "address": F.when(is_s7, s7_address(F.col("area"), F.col("db"), F.col("addr"), F.col("type"), F.col("bit"))),
            "object_code": F.when(is_bacnet, object_type_code(F.col("object_type"))),
            "property_code": F.when(is_bacnet, property_code(F.col("property"))),
            "host": host,
            "port": port,
        }
    ).withColumns({"type": kind, "area": area})
    reason = (
        F.when(is_s7 & ~F.coalesce(F.col("area").isin("DB", "M", "I", "Q"), F.lit(False)), "no such memory area")
        .when(is_s7 & ~F.coalesce(F.col("type").isin(*S7_TYPES), F.lit(False)), "unsupported type")
        .when(is_bacnet & F.col("object_code").isNull(), "unknown object type")
        .when(is_bacnet & F.col("property_code").isNull(), "unknown property")
        .when(X.strip(F.col("server")) == "", "server is blank")
        .when(F.col("server").isNotNull() & F.col("port").isNull(), "invalid port")
    )
    marked = made.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


# -- setpoints -----------------------------------------------------------------------

# Accepted names per rule: (protocol, names, class, bits) (fixed values).
SETPOINT_RULES = (
    ("s7", ("BOOL",), "bool", 0),
    ("s7", ("BYTE",), "unsigned", 8),
    ("s7", ("INT",), "signed", 16),
    ("s7", ("WORD",), "unsigned", 16),
    ("s7", ("DINT",), "signed", 32),
    ("s7", ("DWORD",), "unsigned", 32),
    ("s7", ("REAL",), "float", 32),
    ("s7", ("LREAL",), "float", 64),
    ("s7", ("STRING",), "text", 0),
    ("eip", ("BOOL",), "bool", 0),
    ("eip", ("SINT",), "signed", 8),
    ("eip", ("BYTE", "USINT"), "unsigned", 8),
    ("eip", ("INT", "INT16"), "signed", 16),
    ("eip", ("UINT", "WORD", "UINT16"), "unsigned", 16),
    ("eip", ("DINT", "INT32"), "signed", 32),
    ("eip", ("UDINT", "DWORD", "UINT32"), "unsigned", 32),
    ("eip", ("LINT", "INT64"), "signed", 64),
    ("eip", ("ULINT", "UINT64"), "unsigned", 64),
    ("eip", ("REAL", "FLOAT", "FLOAT32"), "float", 32),
    ("eip", ("LREAL", "DOUBLE", "FLOAT64"), "float", 64),
    ("eip", ("STRING",), "text", 0),
    ("snmp", ("INTEGER", "INT"), "signed", 64),
    ("snmp", ("OCTETSTRING", "STRING", "OBJECTIDENTIFIER", "OID", "IPADDRESS", "IP"), "text", 0),
    ("snmp", ("COUNTER32", "GAUGE32", "UINT32", "TIMETICKS"), "unsigned", 32),
    ("snmp", ("COUNTER64",), "unsigned", 64),
)
FLOAT32_MAX = 3.4028235677973366e38  # first magnitude that rounds to infinity


def _rule(kind: str, bits: int) -> str:
    low = -(1 << bits - 1) if kind == "signed" else 0
    high = (1 << (bits - 1 if kind == "signed" else bits)) - 1 if bits else 0
    return (
        f"named_struct('class', '{kind}', 'bits', {bits}, "
        f"'low', cast('{low}' as decimal(38,0)), 'high', cast('{high}' as decimal(38,0)))"
    )


def validate_setpoints(setpoints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed, rejects) of write values: name, protocol, type, value, string_len.

    The rule of a type is looked up in a literal map, so every check is one
    projection. Controller integers take 0x, 0o and 0b; management integers are
    read up to the first character that is no digit. A controller text of more bytes
    than ``string_len`` (254 where it is not set) is a reject, never cut.
    """
    entries = [
        f"'{protocol}/{n}', {_rule(kind, bits)}"
        for protocol, names, kind, bits in SETPOINT_RULES
        for n in names
    ]
    rules = F.expr(f"map({', '.join(entries)})")
    protocol = F.lower(F.trim("protocol"))
    key = F.concat(protocol, F.lit("/"), F.upper(X.strip(F.col("type"))))
    cut = F.when(F.coalesce("string_len", F.lit(0)) > 0, F.col("string_len")).otherwise(F.lit(254))
    text, kind = F.col("_text"), F.col("_rule.class")
    staged = compute_once(
        setpoints,
        {"_protocol": protocol, "_rule": F.try_element_at(rules, key), "_text": X.strip(F.col("value")), "_cut": cut},
    )
    protocol = F.col("_protocol")
    leading = F.regexp_extract(text, r"^([+-]?\d+)", 1)
    whole = F.when(
        kind.isin("signed", "unsigned"),
        F.when(protocol == "snmp", leading.try_cast("decimal(38,0)")).otherwise(X.parse_integer(text)),
    )
    staged = compute_once(
        staged,
        {
            # Unsigned readers know no sign at all.
            "_whole": F.when(~((kind == "unsigned") & text.rlike("^[+-]")), whole),
            "_num": F.when(kind == "float", X.parse_double(text)),
            "_bool": F.when(kind == "bool", X.parse_bool_text(text)),
        },
    )
    single = F.col("_rule.bits") == 32
    number = F.col("_num")
    finite = F.abs(number) < float("inf")
    reason = (
        F.when(F.col("_rule").isNull(), "unsupported type")
        .when((kind == "bool") & F.col("_bool").isNull(), "neither true nor false")
        .when(kind.isin("signed", "unsigned") & F.col("_whole").isNull(), "invalid integer")
        .when(
            kind.isin("signed", "unsigned") & ~F.col("_whole").between(F.col("_rule.low"), F.col("_rule.high")),
            "value out of range",
        )
        .when((kind == "float") & number.isNull(), "invalid number")
        .when((kind == "float") & single & finite & (F.abs(number) >= FLOAT32_MAX), "value out of range")
        .when((protocol == "s7") & (kind == "text") & (F.octet_length(text) > F.col("_cut")), "text longer than its field")
    )
    marked = staged.withColumn("reason", reason)
    real = F.when(single, number.cast("float").cast("double")).otherwise(number)
    typed = (
        F.when(kind == "bool", V.boolean(F.col("_bool")))
        .when(kind.isin("signed", "unsigned"), V.integer(F.col("_whole")))
        .when(kind == "float", V.num(real))
        .otherwise(V.text(text))
    )
    own = setpoints.columns
    return (
        marked.filter(F.col("reason").isNull()).withColumn("typed", typed).select(*own, "typed"),
        marked.filter(F.col("reason").isNotNull()).select(*own, "reason"),
    )
