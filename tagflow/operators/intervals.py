"""Choosing intervals that do not overlap, earliest start first, for keys of any size.

A scan would go through the candidates of a key one after the other. Here every
candidate points to the first one that starts after its end, found by one ordered pass.
Where a candidate starts after the end of all before it, the choice starts afresh, so
such a candidate is always chosen; the others are chosen if pointers lead to them from
one of these. That is marked by pointer doubling: after step k everything within 2 ** k
choices of a fresh start is known, so the steps grow with the logarithm of the longest
run of overlapping candidates, and stop at once where none overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions.stages import join_on
from tagflow.operators.ordered import SLICE, Ordered
from tagflow.session import ensure_checkpoint_dir


def fixed(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def first_disjoint(
    candidates: DataFrame,
    keys: Sequence[str],
    start: Sequence[str],
    end: Sequence[str],
    touching: bool = False,
    width: str | int = SLICE,
) -> DataFrame:
    """The candidates of each key that a scan by ``start`` would keep: one is kept when it
    starts after the end of the one kept before (with ``touching`` also right at it).

    ``start`` and ``end`` name the columns of a position, most significant first. Candidates
    of a key with the same start are one candidate, with the smallest end.
    """
    keys, start, end = list(keys), list(start), list(end)
    at = [f"_p{i}" for i in range(len(start))]
    place = lambda cols: F.struct(*[F.col(c).alias(n) for c, n in zip(cols, at)])
    behind = (lambda a, b: a >= b) if touching else (lambda a, b: a > b)
    rows = Ordered.of(candidates.select(*keys, *start, place(start).alias("_c_start"), place(end).alias("_c_end")), keys, [*start, "_c_end"], width)
    # Equal starts lie in one slice.
    rows = rows.with_column("_same", F.lag("_c_start").over(rows.window()).eqNullSafe(F.col("_c_start"))).filter(~F.col("_same"))
    rows = rows.add(_top=rows.largest_before(F.col("_c_end")), _after=rows.following(F.col("_c_start")))
    clear = behind(F.col("_after"), F.col("_c_end"))
    nodes = fixed(
        rows.df.select(
            *keys, "_c_start", "_c_end", F.coalesce(behind(F.col("_c_start"), F.col("_top")), F.lit(True)).alias("_fresh"),
            F.when(clear & ~behind(F.col("_after"), F.greatest("_top", "_c_end")), F.col("_after")).alias("_next"),
            F.coalesce(~clear, F.lit(False)).alias("_over"),
        )
    )
    out = [*keys, *[F.col(f"_c_start.{a}").alias(c) for a, c in zip(at, start)], *[F.col(f"_c_end.{a}").alias(c) for a, c in zip(at, end)]]
    if nodes.filter("_over").isEmpty():
        return nodes.select(*out)
    # The end of a candidate that the next one overlaps is put among the starts of all.
    ends, starts = (0, 1) if touching else (1, 0)
    spot = lambda of: [F.col(f"{of}.{a}").alias(a) for a in at]
    line = nodes.filter("_over").select(*keys, *spot("_c_end"), F.lit(ends).alias("_kind"), "_c_start", "_fresh").unionByName(
        nodes.select(*keys, *spot("_c_start"), F.lit(starts).alias("_kind"), "_c_start", "_fresh")
    )
    ordered = Ordered.of(line, keys, [*at, "_kind"], width)
    ordered = ordered.add(_to=ordered.upcoming(F.when(F.col("_kind") == starts, F.struct("_c_start", "_fresh"))))
    found = ordered.df.filter(F.col("_kind") == ends).select(*keys, "_c_start", F.when(~F.col("_to._fresh"), F.col("_to._c_start")).alias("_next"))
    chosen = nodes.filter("_fresh").select(*keys, "_c_start")
    jump = fixed(nodes.select(*keys, "_c_start", "_next").unionByName(found).filter("_next is not null"))
    by = [*keys, "_c_start"]
    while True:
        ahead = join_on(jump, chosen, by, "left_semi").select(*keys, F.col("_next").alias("_c_start")).distinct()
        more = fixed(join_on(ahead, chosen, by, "left_anti"))
        if more.isEmpty():
            break
        chosen = fixed(chosen.unionByName(more))
        onward = jump.select(*keys, F.col("_c_start").alias("_next"), F.col("_next").alias("_far"))
        jump = fixed(join_on(jump, onward, [*keys, "_next"]).select(*keys, "_c_start", F.col("_far").alias("_next")))
    return join_on(nodes, chosen, by, "left_semi").select(*out)
