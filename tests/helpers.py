from __future__ import annotations

from pyspark.sql import functions as F

from tagflow.functions import values as V


def plain(value):
    """Python value of a VALUE_T row."""
    return None if value is None or value["kind"] == "null" else value[value["kind"]]


def fields_of(row):
    return {k: float(plain(v)) if v["kind"] in ("num", "int") else plain(v) for k, v in row["fields"].items()}


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if not order else out


def one_column(spark, texts, name="s"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")


def by_index(df, column):
    return [r[1] for r in sorted((r["i"], r[column]) for r in df.select("i", column).collect())]


__all__ = ["F", "V", "by_index", "fields_of", "one_column", "plain", "rows"]
