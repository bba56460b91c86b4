"""VALUE_T: one struct column for values of any type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagflow.functions.stages import let

_SLOTS = {
    "num": "double",
    "int": "decimal(20,0)",
    "str": "string",
    "bool": "boolean",
    "json": "string",
}


def typed(kind: str, value: Column | None = None) -> Column:
    """A VALUE_T of ``kind``; a null value gives kind ``null``."""
    slots = [
        (value.cast(t) if value is not None and slot == kind else F.lit(None).cast(t)).alias(slot)
        for slot, t in _SLOTS.items()
    ]
    if kind == "null":
        label = F.lit("null")
    else:
        label = F.when(value.isNull(), "null").otherwise(kind)
    return F.struct(label.alias("kind"), *slots)


def num(value: Column) -> Column:
    return typed("num", value)


def integer(value: Column) -> Column:
    return typed("int", value)


def text(value: Column) -> Column:
    return typed("str", value)


def boolean(value: Column) -> Column:
    return typed("bool", value)


def null() -> Column:
    return typed("null")


def _kind_of_json(text: Column) -> Column:
    """Kind by the look of the JSON text."""
    first = F.substring(text, 1, 1)
    return (
        F.when(text.isNull() | (text == "null"), "null")
        .when(first == '"', "str")
        .when(first.isin("{", "["), "json")
        .when(text.isin("true", "false"), "bool")
        .when(text.contains(".") | text.contains("E") | text.contains("e"), "num")
        .otherwise("int")
    )


def variant_kind(value: Column) -> Column:
    """VALUE_T kind of a JSON variant (missing and JSON null are both ``null``)."""
    return let(F.to_json(value), _kind_of_json)


# What schema_of_variant calls a value of these kinds; numbers may also have other names.
_PLAIN = {"null": "VOID", "str": "STRING", "int": "BIGINT", "bool": "BOOLEAN"}


def is_kind(value: Column, *kinds: str) -> Column:
    """True when `variant_kind` is one of ``kinds``; values are written out only where the type's name leaves it open."""
    plain = F.coalesce(F.schema_of_variant(value), F.lit("VOID")).isin(*[_PLAIN[k] for k in kinds if k in _PLAIN])
    return plain | variant_kind(value).isin(*kinds)


def from_variant(value: Column) -> Column:
    """JSON variant to VALUE_T.

    A number without a fraction is kind ``int``; beyond 20 digits it is ``num``.
    """

    def build(kind: Column, text: Column, bound: Column) -> Column:
        return F.struct(
            kind.alias("kind"),
            F.when(kind == "num", text.try_cast("double")).alias("num"),
            F.when(kind == "int", text.try_cast("decimal(20,0)")).alias("int"),
            F.when(kind == "str", F.try_variant_get(bound, "$", "string")).alias("str"),
            F.when(kind == "bool", text == "true").alias("bool"),
            F.when(kind == "json", text).alias("json"),
        )

    def settle(text: Column) -> Column:
        kind = _kind_of_json(text)
        too_long = (F.length(text) > 19) & text.try_cast("decimal(20,0)").isNull()
        return F.when(too_long & (kind == "int"), "num").otherwise(kind)

    return let(
        value,
        lambda bound: let(
            F.to_json(bound),
            lambda text: let(settle(text), lambda kind: build(kind, text, bound)),
        ),
    )


def as_double(value: Column) -> Column:
    """Numeric reading of a VALUE_T; null for text, booleans and nested values."""
    return F.coalesce(value["num"], value["int"].cast("double"))


def as_text(value: Column) -> Column:
    return F.coalesce(
        value["str"],
        value["int"].cast("string"),
        value["num"].cast("string"),
        value["bool"].cast("string"),
        value["json"],
    )


def is_storable(value: Column) -> Column:
    """False for null, NaN and infinite values, which no store accepts."""
    n = value["num"]
    infinite = F.lit(float("inf"))
    finite = ~F.isnan(n) & (n < infinite) & (n > -infinite)
    return value.isNotNull() & (value["kind"] != "null") & F.coalesce(finite, F.lit(True))
