"""Request/response captures of controllers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# -- FINS multiple memory area read ------------------------------------------------

FINS_HEADER = 14
# Area codes that answer with one byte per item (fixed values): DM, CIO, W, H, A bits.
FINS_BIT_AREAS = (0x02, 0x30, 0x31, 0x32, 0x33)

# One item at the head of the remaining hex text: area code, then one byte for a
# bit area and two bytes for any other code.
_FINS_ITEM = "((?:02|30|31|32|33)(?:[0-9A-F]{2})|(?!02|30|31|32|33)[0-9A-F]{2}[0-9A-F]{4})"


def fins_results(captures: DataFrame, keep: tuple[str, ...] = ("device", "seq")) -> tuple[DataFrame, DataFrame]:
    """(items, rejects) of captured multi-read responses.

    A null payload, a response under 14 bytes and a non-zero end code are rejects.
    Items are sized by the echoed area code. With an ``expected`` column (items
    asked for) missing or cut items reject the capture. The layout is regular
    enough to be read by a pattern over the hex text, inside the JVM.
    """
    has_expected = "expected" in captures.columns
    hexed = F.hex(F.col("bytes"))
    marked = (
        captures.withColumn("_code", F.substring(hexed, 25, 4))
        .withColumn("_body", F.coalesce(F.expr(f"substring(hex(bytes), {2 * FINS_HEADER + 1})"), F.lit("")))
    )
    # \G keeps items adjacent: matching stops at the first cut item.
    items = F.regexp_extract_all("_body", F.lit(r"\G" + _FINS_ITEM), F.lit(1))
    marked = marked.withColumn("_all", items)
    used = F.length(F.array_join("_all", ""))
    if has_expected:
        wanted = F.coalesce(F.col("expected"), F.lit(0))
        reason = (
            F.when(F.size("_all") >= wanted, None)
            .when(used < F.length("_body"), F.concat(F.lit("item cut at position "), F.size("_all")))
            .otherwise(F.concat(F.lit("no item at position "), F.size("_all")))
        )
        chosen = F.slice("_all", F.lit(1), F.greatest(wanted, F.lit(0)))
    else:
        reason = F.when(used < F.length("_body"), F.concat(F.lit("item cut at position "), F.size("_all")))
        chosen = F.col("_all")
    marked = marked.withColumn(
        "reason",
        F.when(F.col("bytes").isNull(), "no payload")
        .when(F.length("bytes") < FINS_HEADER, "shorter than a response head")
        .when(F.col("_code") != "0000", F.concat(F.lit("end code "), F.col("_code")))
        .otherwise(reason),
    )
    item = F.col("_item")
    rows = (
        marked.filter(F.col("reason").isNull())
        .select(*keep, F.posexplode(chosen).alias("pos", "_item"))
        .select(
            *keep,
            "pos",
            F.conv(F.substring(item, 1, 2), 16, 10).cast("int").alias("area"),
            (F.length(item) == 4).alias("is_bit"),
            F.conv(F.expr("substring(_item, 3)"), 16, 10).cast("int").alias("value"),
        )
    )
    return rows, marked.filter(F.col("reason").isNotNull()).select(*keep, "reason")


def fins_reads(captures: DataFrame, keep: tuple[str, ...] = ("device", "seq")) -> tuple[DataFrame, DataFrame]:
    """(values, rejects) of captured answers to a read of one area.

    ``captures``: keep columns, ``bytes`` and what was asked for: ``area`` (code), ``address``
    (word), ``bit`` (first bit, for bit areas) and ``expected`` (how many). Words take two
    bytes each and follow each other by address; bits take one byte each, of which the
    lowest bit counts, and go on into the next word behind bit 15. Bytes behind the
    expected values are not read; an answer that holds fewer is a reject, as are those of
    ``fins_results``.
    """
    wanted = F.greatest(F.coalesce("expected", F.lit(0)), F.lit(0))
    is_bit = F.coalesce(F.col("area").isin(*FINS_BIT_AREAS), F.lit(False))
    size = F.when(is_bit, 1).otherwise(2)
    there = F.floor((F.octet_length("bytes") - FINS_HEADER) / size).cast("int")
    code = F.substring(F.hex("bytes"), 25, 4)
    marked = captures.withColumns({
        "_bit": is_bit, "_size": size, "_wanted": wanted,
        "reason": F.when(F.col("bytes").isNull(), "no payload")
        .when(F.octet_length("bytes") < FINS_HEADER, "shorter than a response head")
        .when(code != "0000", F.concat(F.lit("end code "), code))
        .when(there < wanted, F.concat(there.cast("string"), F.lit(" values of "), wanted.cast("string"))),
    })
    first = F.coalesce("bit", F.lit(0)) + F.col("pos")
    cell = F.substring("bytes", FINS_HEADER + 1 + F.col("pos") * F.col("_size"), F.col("_size"))
    number = F.conv(F.hex(cell), 16, 10).cast("int")
    rows = marked.filter(F.col("reason").isNull() & (F.col("_wanted") > 0)).withColumn(
        "pos", F.explode(F.sequence(F.lit(0), F.col("_wanted") - 1))
    )
    values = rows.select(
        *keep, "pos", "area",
        F.when(F.col("_bit"), F.col("address") + F.floor(first / 16)).otherwise(F.col("address") + F.col("pos")).cast("int").alias("address"),
        F.when(F.col("_bit"), F.pmod(first, F.lit(16))).cast("int").alias("bit"),
        F.when(F.col("_bit"), F.pmod(number, F.lit(2))).otherwise(number).alias("value"),
    )
    return values, marked.filter(F.col("reason").isNotNull()).select(*keep, "reason")
