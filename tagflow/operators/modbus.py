"""Register writes received from masters, and the register image they build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANK_SIZE = 2000
# First address shown for each register bank (fixed values).
BANK_BASE = {"coil": 1, "discrete_input": 10001, "input_register": 30001, "holding_register": 40001}
BIT_BANKS = ("coil", "discrete_input")


def modbus_writes(
    events: DataFrame, unit: int = 0, bank_size: int = BANK_SIZE, keep: Sequence[str] = ("server", "seq")
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): one row per written register.

    Input: type, unitId, addr, quantity, values ARRAY<INT>, clientAddr, timestamp.
    ``unit`` 0 takes every unit. The shown address is at least five digits.
    """
    end = F.col("addr") + F.col("quantity")
    holds = lambda test: F.coalesce(test, F.lit(False))  # noqa: E731  a null member is a reject
    reason = (
        F.when(F.lit(unit != 0) & ~holds(F.col("unitId") == unit), "other unit")
        .when(~holds(F.col("type").isin("coil", "holding_register")), "bank is not writable")
        .when(~holds((F.col("addr") >= 0) & (F.col("quantity") >= 0) & (end <= bank_size)), "illegal data address")
        .when(~holds(F.size("values") >= F.col("quantity")), "illegal data value")
    )
    marked = events.withColumn("reason", reason)
    base = F.create_map(*[F.lit(x) for kv in BANK_BASE.items() for x in kv])
    rows = (
        marked.filter(F.col("reason").isNull())
        .select(
            *keep, "type", "unitId", "addr", "quantity", "clientAddr", "timestamp",
            F.format_string("%05d", base[F.col("type")] + F.col("addr")).alias("modbus_addr"),
            F.posexplode(F.slice("values", F.lit(1), F.col("quantity"))).alias("pos", "value"),
        )
        .withColumn("address", F.col("addr") + F.col("pos"))
    )
    return rows, marked.filter(F.col("reason").isNotNull()).select(*keep, "type", "unitId", "addr", "reason")


def register_image(
    rows: DataFrame,
    as_of_ns: int | None = None,
    server: str = "server",
) -> DataFrame:
    """Last write per (server, bank, address) up to ``as_of_ns``.

    Combined before the shuffle: a register written a billion times sends one row
    per task. Every address is kept; ``modbus_writes`` has checked them against its bank.
    """
    seen = rows if as_of_ns is None else rows.filter(F.col("timestamp") <= as_of_ns)
    return (
        seen.groupBy(server, F.col("type").alias("bank"), "address")
        .agg(
            F.max_by("value", F.struct("timestamp", "seq", "pos")).alias("value"),
            F.max("timestamp").alias("written_ns"),
        )
    )


def read_range(
    image: DataFrame,
    bank: str,
    start: int,
    quantity: int,
    server: str = "server",
    bank_size: int = BANK_SIZE,
) -> DataFrame:
    """Registers ``start``.. of every server; registers never written read 0."""
    if start < 0 or start + quantity > bank_size:
        raise ValueError("illegal data address")
    servers = image.select(server).distinct()
    wanted = servers.select(
        server, F.explode(F.sequence(F.lit(start), F.lit(start + quantity - 1))).alias("address")
    )
    stored = image.filter((F.col("bank") == bank) & F.col("address").between(start, start + quantity - 1))
    return wanted.join(stored.select(server, "address", "value"), [server, "address"], "left").select(
        server, F.lit(bank).alias("bank"), "address", F.coalesce("value", F.lit(0)).alias("value")
    )
