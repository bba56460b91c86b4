"""Trap messages of managed devices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once
from tagflow.sources.messages import is_whole_json

TRAP_OID = "1.3.6.1.6.3.1.1.4.1.0"
TRAP = (
    "struct<from:string,version:string,community:string,timestamp:bigint,"
    "variables:array<struct<oid:string,value:variant,type:string>>>"
)
# Version numbers inside a packet (fixed values); payloads carry the text form.
VERSIONS = {"0": "v1", "1": "v2c", "3": "v3"}
BYTE_TYPES = ("OctetString", "Opaque", "BitString")


def snmp_traps(
    packets: DataFrame, data_col: str = "data", keep: Sequence[str] = ("msg_id",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(traps, varbinds, rejects) of JSON trap payloads.

    The trap OID is taken from the variables. Byte values arrive as base64 in
    this payload and come out as bytes (``raw``); text that is no base64 is kept.
    A payload has to be one JSON object and nothing behind it, with an array of objects
    as variables; the others are rejects, with a ``reason``.
    """
    parsed = compute_once(
        packets,
        {
            "_t": F.from_json(F.col(data_col), TRAP),
            "_list": F.try_variant_get(F.try_parse_json(data_col), "$.variables", "array<variant>"),
            "_whole": is_whole_json(F.col(data_col)),
        },
    )
    objects = F.forall("_list", lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    reason = (
        F.when(~F.col("_whole"), "not one JSON value")
        .when(F.col("_list").isNull(), "no list of variables")
        .when(~objects | F.col("_t.variables").isNull(), "a variable is no object")
    )
    parsed = parsed.withColumn("reason", reason).drop("_list", "_whole")
    readable = F.col("reason").isNull()
    own = F.filter(
        F.col("_t.variables"),
        lambda v: (F.regexp_replace(v["oid"], r"^\.", "") == TRAP_OID)
        & (V.variant_kind(v["value"]) == "str"),
    )
    first = F.try_element_at(own, F.lit(1))
    trap_oid = F.regexp_replace(F.try_variant_get(first["value"], "$", "string"), r"^\.", "")
    version = F.col("_t.version")
    known = F.when(version.isin("v1", "v2c", "v3"), version).otherwise(
        F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in VERSIONS.items() for x in kv]), version), F.lit("unknown"))
    )
    traps = parsed.filter(readable).select(
        *keep,
        F.col("_t.from").alias("from"),
        known.alias("version"),
        F.col("_t.community").alias("community"),
        F.col("_t.timestamp").alias("timestamp"),
        F.coalesce(trap_oid, F.lit("")).alias("trap_oid"),
        F.size("_t.variables").alias("variables"),
    )
    v = F.col("_v")
    is_bytes = v["type"].isin(*BYTE_TYPES)
    as_text = F.try_variant_get(v["value"], "$", "string")
    raw = F.when(is_bytes, F.try_to_binary(as_text, F.lit("base64")))
    varbinds = parsed.filter(readable).select(
        *keep, F.posexplode("_t.variables").alias("pos", "_v")
    ).select(
        *keep,
        "pos",
        X.normalize_oid(v["oid"]).alias("oid"),
        v["type"].alias("type"),
        F.when(raw.isNull(), V.from_variant(v["value"])).otherwise(V.null()).alias("value"),
        raw.alias("raw"),
    )
    return traps, varbinds, parsed.filter(~readable).select(*keep, data_col, "reason")
