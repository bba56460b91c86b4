"""Registered queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# Events as the Spark side shapes them.
EV = (
    "(select event_id, user_id, event_type, value, epoch_us(ts) * 1000 as ts_ns, "
    "cast(regexp_extract(props, '(\\d+)', 1) as bigint) as k from events)"
)

# The same with three devices, so that each holds a third of all rows.
EV_HOT = EV.replace("user_id,", "user_id % 3 as user_id,", 1)


def hot_sql(sql: str) -> str:
    return sql.replace(EV, EV_HOT)


def hot(ev: DataFrame) -> DataFrame:
    """Events of three devices, each of which holds a third of all rows."""
    return ev.withColumn("user_id", ev["user_id"] % 3)


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def load() -> dict:
    from entry_queries import control, decode, lookups, points, series, streams, windows  # noqa: F401

    return REGISTRY
