"""Keeping long chains of computed columns small."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later steps refer to many times.

    Adjacent projections are merged by the optimizer, which copies an expression
    to every place it is used; a chain of such columns can outgrow generated
    code. A one-row ``inline`` keeps them apart, still inside one stage.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_as_text(df, columns):
    """(df with the given columns as text, function that puts their types back).

    Pandas turns whole numbers into floats where a null is among them, so keys pass
    through Python as text. Text and binary columns stay as they are.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name in columns}
    changed = {k: t for k, t in kinds.items() if t.typeName() not in ("string", "binary")}
    text = df.withColumns({k: F.col(k).cast("string") for k in changed}) if changed else df

    def back(out):
        there = {k: t for k, t in changed.items() if k in out.columns}
        return out.withColumns({k: F.col(k).cast(t) for k, t in there.items()}) if there else out

    return text, back


def text_schema(schema: str, df, columns) -> str:
    """The schema with the columns that ``whole_as_text`` changes as strings."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields if f.name in columns}
    fields = T.StructType.fromDDL(schema).fields
    kept = lambda f: f.name not in kinds or kinds[f.name] in ("string", "binary")
    return ", ".join(f"`{f.name}` {f.dataType.simpleString() if kept(f) else 'string'}" for f in fields)


def join_on(left: DataFrame, right: DataFrame, columns, how: str = "inner") -> DataFrame:
    """Join on equal columns, null equal to null; the right side's columns of these names go."""
    own = {c: f"_join_{i}" for i, c in enumerate(columns)}
    other = right.select(*[F.col(c).alias(own.get(c, c)) for c in right.columns])
    on = None
    for c, o in own.items():
        same = F.col(c).eqNullSafe(F.col(o))
        on = same if on is None else on & same
    return left.join(other, on, how).drop(*own.values())
