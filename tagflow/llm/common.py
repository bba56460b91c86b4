"""Column helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.session import ensure_checkpoint_dir

# Space, tab, line feed, vertical tab, form feed, carriage return; no other space ends a word.
SPACES = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` computed once, also where `body` names it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between ASCII white space, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def ascii_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII characters; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart (null differs from empty)."""
    return F.xxhash64(text, F.length(text))


def row_key(*columns: Column) -> Column:
    """One text for the values, null told from any value, for joins on a single key."""
    return F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns])


def uniform(*parts) -> Column:
    """A number in [0, 1) fixed by its arguments."""
    bits = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))


def cut(df: DataFrame) -> DataFrame:
    """Fix rows in the shared checkpoint folder; later plans start from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Bits of a Bloom filter: so many for each key, and at most one megabyte in all. It only
# spares a join rows, so a fuller filter costs time and changes no result.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 23


@dataclass(frozen=True)
class Bloom:
    """``bits`` bits as one array of longs, two of them set for each key."""

    bits: int
    longs: Column


def _bits_of(h: Column, bits: int) -> tuple[Column, Column]:
    return F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 24), F.lit(bits))


def bloom(hashes: DataFrame) -> Bloom:
    """A Bloom filter of column h, of a size that follows the number of its values."""
    keys = hashes.select("h").distinct()
    wanted = BITS_A_KEY * max(keys.count(), 1)
    size = min(max(1 << (wanted - 1).bit_length(), LEAST_BITS), MOST_BITS)
    bits = keys.select(F.explode(F.array(*_bits_of(F.col("h"), size))).alias("b")).distinct()
    one = F.expr("shiftleft(1L, cast(b % 64 as int))")
    filled = bits.groupBy((F.col("b") / 64).cast("int").alias("at")).agg(F.bit_or(one).alias("v")).collect()
    longs = [0] * (size // 64)
    for row in filled:
        longs[row["at"]] = row["v"]
    return Bloom(size, F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>"))


def may_hold(mask: Bloom, h: Column) -> Column:
    def test(b: Column) -> Column:
        return F.bit_get(F.get(mask.longs, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1

    first, second = _bits_of(h, mask.bits)
    return test(first) & test(second)


def ranked(df: DataFrame, keys: list[str], order: list[str], rank: str = "rank", total: str | None = None) -> DataFrame:
    """Adds each row's place (from 0) by `order` among the rows of its keys, and their number as `total`.

    Rows are sorted over the cluster and numbered within their task; the counts of
    (task, keys) give what lies in front. So a key may span any number of tasks; what is
    windowed is one row for each task and key. The sorted rows are fixed in the checkpoint
    folder: range borders come from a sample, and another run could draw other ones.
    """
    task = F.shiftright("__id", 33)
    placed = cut(
        df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    runs = placed.groupBy(task.alias("__task"), *keys).agg(F.min("__id").alias("__from"), F.count("*").alias("__rows"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("__task").alias("__t"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__from")).alias("__shift"), F.sum("__rows").over(key).alias("__all"),
    )
    on = [task == F.col("__t")] + [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    out = [*[F.col(c) for c in df.columns], (F.col("__id") + F.col("__shift")).alias(rank)]
    return placed.join(runs, on).select(*out, *([F.col("__all").alias(total)] if total else []))
