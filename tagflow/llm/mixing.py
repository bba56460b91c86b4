"""Mixing sources to target weights by pivotal rounding in a reduction tree.

Every document of a source gets the same expected number of copies, target / source
size. Its fraction is rounded by pivotal steps: two fractional documents move words
between them, in a random direction that keeps both expectations, until one of the
two is integral. Blocks of documents run these steps side by side; each leaves one
fractional document, and those meet in the blocks of the next level, until a source
has one block. A step keeps the sum of words, so a source's taken words miss its
target by less than the size of one document.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of
its own; repeated rows (same doc_id, source and text) are units of their own; an empty
table gives an empty result; a source whose sizes are all 0 has target 0. Random
numbers are hashes of the rows' own values, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.llm.common import cut, let, row_key, text_key, uniform, words

SHARE = 1.5
MOST_COPIES = 2.0
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 128
SEED = 17

UNIT = ["doc_id", "source", "size", "tk", "copy"]


def source_targets(units: DataFrame, share=SHARE, most=MOST_COPIES, weights=WEIGHTS) -> DataFrame:
    """source, source_size, n_docs, target: words by weight, none above `most` times its size.

    With sources ordered by the water level at which they fill up, the level that is
    reached is the largest of those computed with all earlier sources full.
    """
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1),
    ).withColumn("full", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left_words = total - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("at", left_words / left_weight).withColumn("level", F.max("at").over(everything))
    return levels.select(
        "source", "source_size", "n_docs", F.least("full", F.col("level") * F.col("weight")).alias("target")
    )


def _step(a: Column, b: Column, draw: Column) -> Column:
    """One pivotal step of residual `a` and newcomer `b`: (integral one, its copies, the other)."""
    up_a, up_b = (1 - a["p"]) * a["s"], (1 - b["p"]) * b["s"]
    have_a, have_b = a["p"] * a["s"], b["p"] * b["s"]
    to_a, to_b = F.least(up_a, have_b), F.least(have_a, up_b)
    clamp = lambda p: F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
    held = lambda x, p: F.struct(x["u"].alias("u"), x["s"].alias("s"), clamp(p).alias("p"))
    out = lambda x, n, rest: F.struct(
        F.struct(x["u"].alias("u"), F.lit(n).alias("take")).alias("done"), rest.alias("rest")
    )
    gains_a = F.when(up_a <= have_b, out(a, 1, held(b, b["p"] - to_a / b["s"]))).otherwise(
        out(b, 0, held(a, a["p"] + to_a / a["s"]))
    )
    gains_b = F.when(have_a <= up_b, out(a, 0, held(b, b["p"] + to_b / b["s"]))).otherwise(
        out(b, 1, held(a, a["p"] - to_b / a["s"]))
    )
    return F.when(draw * (to_a + to_b) < to_b, gains_a).otherwise(gains_b)


def _fold(rows: Column, level: int, seed: int) -> Column:
    """Run the steps along one block: struct(done: array, rest: the fractional document left)."""
    none = F.filter(F.transform(rows, lambda x: F.struct(x["u"].alias("u"), F.lit(0).alias("take"))), lambda x: F.lit(False))
    first = F.get(rows, F.lit(0))
    start = F.struct(
        none.alias("done"), F.struct(first["u"].alias("u"), first["s"].alias("s"), first["p"].alias("p")).alias("rest")
    )
    return F.aggregate(
        F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))),
        start,
        lambda acc, x: let(
            _step(acc["rest"], x, uniform(seed, level, x["u"])),
            lambda r: F.struct(
                F.concat(acc["done"], F.array(r["done"])).alias("done"), r["rest"].alias("rest")
            ),
        ),
    )


def round_copies(units: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Round `p` of every unit (UNIT columns, `p`, and `n` units of its source) to `take` 0 or 1.

    Units without words or with an integral `p` are settled at once.
    """
    fractional = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    settled = units.where(~fractional).select(*UNIT, (F.col("p") >= 1).cast("int").alias("take"))
    todo = units.where(fractional).select(
        F.struct(*UNIT).alias("u"), F.col("size").cast("double").alias("s"), "p", F.col("n").cast("double").alias("n")
    )
    largest = todo.agg(F.max("n")).first()[0] or 0
    parts, level = [settled], 0
    while True:
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1))
        placed = todo.withColumn("blocks", blocks).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "u"), F.col("blocks"))
        )
        entry = F.struct(F.xxhash64(F.lit(seed + 1), F.lit(level), "u").alias("o"), "u", "s", "p")
        folded = cut(
            placed.groupBy(F.col("u.source").alias("source"), "block")
            .agg(F.sort_array(F.collect_list(entry)).alias("rows"), F.max("blocks").alias("n"))
            .select(_fold(F.col("rows"), level, seed).alias("f"), F.col("n").cast("double").alias("n"))
        )
        parts.append(folded.select(F.explode("f.done").alias("d")).select("d.u.*", "d.take"))
        todo = folded.select("f.rest.u", "f.rest.s", "f.rest.p", "n")
        largest, level = math.ceil(largest / block), level + 1
        if largest <= 1:
            break
    last = todo.select("u.*", (uniform(seed, -1, F.col("u")) < F.col("p")).cast("int").alias("take"))
    out = last
    for part in parts:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, share=SHARE, most=MOST_COPIES, weights=WEIGHTS, block=BLOCK, seed=SEED) -> DataFrame:
    """doc_id, source, tk (text hash), size, source_size, target, copies, taken; one row per document row."""
    rows = docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), text_key(F.col("text")).alias("tk")
    )
    units = cut(
        rows.groupBy("doc_id", "source", "size", "tk")
        .agg(F.count("*").alias("m"))
        .select("doc_id", "source", "size", "tk", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy"))
    )
    targets = cut(source_targets(units, share, most, weights))
    s = targets.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("c"),
        F.col("n_docs").alias("n"),
    )
    whole = F.when(F.abs(F.col("c") - F.round("c")) < 1e-9, F.round("c")).otherwise(F.floor("c"))
    joined = units.join(s, F.col("source").eqNullSafe(F.col("of")))
    p = F.greatest(F.col("c") - whole, F.lit(0.0))
    p = F.when(p < 1e-9, F.lit(0.0)).otherwise(p)
    taken = round_copies(joined.select(*UNIT, p.alias("p"), "n"), block, seed)
    out = taken.join(s, F.col("source").eqNullSafe(F.col("of")))
    copies = (whole + F.col("take")).cast("long")
    return out.select(
        "doc_id", "source", "tk", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix takes, all columns, with `copies`: how often each is taken.

    Repeated rows (same doc_id, source and text) become one with their copies added up.
    """
    key = "__row_key"
    parts = lambda tk: row_key(F.col("doc_id"), F.col("source"), tk)
    taken = (
        mix(docs, **options).groupBy(parts(F.col("tk")).alias(key)).agg(F.sum("copies").alias("__copies"))
        .where(F.col("__copies") > 0)
    )
    rows = docs.withColumn(key, parts(text_key(F.col("text")))).join(taken, key)
    again = Window.partitionBy(key).orderBy(key)
    one = rows.withColumn("__copy", F.row_number().over(again)).where(F.col("__copy") == 1)
    return one.withColumn("copies", F.col("__copies")).drop(key, "__copy", "__copies")
