"""Event sequences: ordered steps of one key inside a time bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions.text import parse_duration_ms
from tagflow.operators.intervals import first_disjoint
from tagflow.operators.ordered import SLICE, Ordered


def sequence_match(
    events: DataFrame,
    steps: Sequence[str],
    within: str,
    keys: Sequence[str] = ("device",),
    ts: str = "ts_ns",
    seq: str = "seq",
    width: str | int = SLICE,
) -> DataFrame:
    """Matches of ``steps`` (SQL predicates, in order) whose last step is at most
    ``within`` after the first; matches do not overlap, the earliest start wins.

    From any start the earliest end is found by chaining "first later row that
    fits the next step" backwards from the last step: ordered values over slices of
    ``width``, no self join. Starts that complete in time are candidates, of which
    ``first_disjoint`` keeps those a scan would keep.
    """
    keys = list(keys)
    bound_ns = parse_duration_ms(within) * 1_000_000
    flags = {f"_s{i}": F.coalesce(F.expr(p), F.lit(False)) for i, p in enumerate(steps)}
    used = events.select(*keys, F.col(ts).alias("_ts"), F.col(seq).alias("_seq"), *[c.alias(n) for n, c in flags.items()])
    used = used.filter(" or ".join(flags))
    rows = Ordered.of(used, keys, ["_ts", "_seq"], width)
    here = F.struct(F.col("_ts").alias("ts"), F.col("_seq").alias("seq"))
    last = len(steps) - 1
    rows = rows.with_column(f"_e{last}", F.when(F.col(f"_s{last}"), here))
    for i in range(last - 1, -1, -1):
        rows = rows.add(**{f"_n{i}": rows.upcoming(F.col(f"_e{i + 1}"))})
        rows = rows.with_column(f"_e{i}", F.when(F.col(f"_s{i}"), F.col(f"_n{i}")))
    candidates = rows.df.filter(
        F.col("_e0").isNotNull() & (F.col("_e0.ts") - F.col("_ts") <= bound_ns)
    ).select(
        *keys,
        F.col("_ts").alias("start_ts_ns"),
        F.col("_seq").alias("start_seq"),
        F.col("_e0.ts").alias("end_ts_ns"),
        F.col("_e0.seq").alias("end_seq"),
    )
    kept = first_disjoint(candidates, keys, ["start_ts_ns", "start_seq"], ["end_ts_ns", "end_seq"], width=width)
    return kept.select(*keys, "start_ts_ns", "end_ts_ns")
