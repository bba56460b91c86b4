"""On-delay, off-delay and watchdog logic as keyed event-time operators.

Times are nanoseconds. Rows of a key are ordered by (ts, seq). When a row sits
exactly on a deadline the row wins over the alarm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.operators.ordered import SLICE, Ordered

NS_PER_MS = 1_000_000


def _duration(df: DataFrame, setting: str) -> Column:
    """A column of that name holds the duration per row; else it is a fixed text."""
    if setting in df.columns:
        return X.duration_ms(F.col(setting))
    ms = X.parse_duration_ms(setting)
    return F.lit(ms).cast("bigint")


def control_failures(df: DataFrame, duration: str) -> tuple[DataFrame, DataFrame]:
    """(usable, failures): rows whose duration cannot be read touch no state."""
    marked = df.withColumn("_ms", _duration(df, duration))
    return (
        marked.filter(F.col("_ms").isNotNull()),
        marked.filter(F.col("_ms").isNull())
        .drop("_ms")
        .withColumn("reason", F.lit("invalid duration")),
    )


def _timer(
    df: DataFrame,
    on_delay: bool,
    keys: Sequence[str],
    ts: str,
    seq: str,
    input_col: str,
    pt: str,
    as_of_ns: int | None,
    width: str | int,
) -> DataFrame:
    usable, _ = control_failures(df, pt)
    signal = F.col(input_col)
    if dict(df.dtypes)[input_col] == "string":
        signal = X.to_bool(signal)
    usable = usable.withColumn("_in", F.coalesce(signal, F.lit(False)))
    rows = Ordered.of(usable, keys, [ts, seq], width)
    before = (Window.unboundedPreceding, -1)
    pt_ns = F.col("_ms") * NS_PER_MS
    # Edges inside a slice are known at once; whether its first row is one too depends on
    # what the slice before ended with, so the summaries decide that.
    was = F.lag("_in").over(rows.window())
    rows = rows.with_column("_turns", F.coalesce(was != F.col("_in"), F.lit(False)))
    edge = F.when(F.col("_turns"), F.struct(F.col(ts).alias("at"), pt_ns.alias("pt")))
    first = F.col("_s_first")
    rows = rows.hand_over(
        {
            "_l_first": was.isNull(),
            "_l_last": F.last(edge, ignorenulls=True).over(rows.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_l_next": F.last(edge["at"], ignorenulls=True).over(rows.window(True).rowsBetween(*before)),
        },
        {
            "_s_first": rows.edge(F.struct(F.col("_in").alias("on"), F.struct(F.col(ts).alias("at"), pt_ns.alias("pt")).alias("e")), None, True),
            "_s_on": rows.edge(F.col("_in"), None, False),
            "_s_last": rows.edge(edge, F.col("_turns"), False),
            "_s_next": rows.edge(edge["at"], F.col("_turns"), True),
        },
        {
            "_e_first": F.when(first["on"] != F.coalesce(F.lag("_s_on").over(rows.across()), F.lit(False)), first["e"]),
            "_e_last": F.last(F.coalesce("_s_last", "_e_first"), ignorenulls=True).over(rows.across().rowsBetween(*before)),
            "_e_next": F.last(F.coalesce("_e_first.at", "_s_next"), ignorenulls=True).over(rows.across(True).rowsBetween(*before)),
        },
    )
    # Only edges can arm or cancel, so the next edge is all a commit needs to know.
    rows = rows.with_column("_last", F.coalesce("_l_last", "_e_first", "_e_last"))
    rows = rows.with_column("_next", F.coalesce("_l_next", "_e_next"))
    rows = rows.with_column("_edge", F.col("_turns") | (F.col("_l_first") & F.col("_e_first").isNotNull()))
    due = F.col("_last.at") + F.col("_last.pt")
    if on_delay:
        q = F.col("_in") & ((F.col("_last.pt") <= 0) | (F.col(ts) > due))
    else:
        q = F.col("_in") | ((F.col("_last.pt") > 0) & (F.col(ts) <= due))
    commit_at = F.col(ts) + pt_ns
    fires = (
        F.col("_edge")
        & (F.col("_in") == F.lit(on_delay))
        & (F.col("_ms") > 0)
        & (F.col("_next").isNull() | (F.col("_next") > commit_at))
    )
    if as_of_ns is not None:
        fires = fires & (commit_at <= as_of_ns)
    echo = F.struct(F.col(ts).alias("at"), F.lit("input").alias("kind"), F.coalesce(q, F.lit(False)).alias("q"))
    commit = F.struct(commit_at.alias("at"), F.lit("commit").alias("kind"), F.lit(on_delay).alias("q"))
    made = rows.df.withColumn("_out", F.explode(F.when(fires, F.array(echo, commit)).otherwise(F.array(echo))))
    types = dict(df.dtypes)
    return made.select(
        *[F.col("_out.at").cast(types[c]).alias(c) if c == ts else F.col(c) for c in df.columns],
        F.col("_out.kind").alias("kind"), F.col("_out.q").alias("q"),
    )


def timer_ton(
    df: DataFrame,
    keys: Sequence[str] = ("device",),
    ts: str = "ts_ns",
    seq: str = "seq",
    input_col: str = "input",
    pt: str = "pt",
    as_of_ns: int | None = None,
    width: str | int = SLICE,
) -> DataFrame:
    """On-delay: q turns true once the input has held true for ``pt``.

    Every input row comes back with q; a commit row is added at the moment of
    the delayed switch. ``width`` is the time of one slice, see ``ordered``. ``pt`` names a column or is a fixed duration.
    """
    return _timer(df, True, keys, ts, seq, input_col, pt, as_of_ns, width)


def timer_tof(
    df: DataFrame,
    keys: Sequence[str] = ("device",),
    ts: str = "ts_ns",
    seq: str = "seq",
    input_col: str = "input",
    pt: str = "pt",
    as_of_ns: int | None = None,
    width: str | int = SLICE,
) -> DataFrame:
    """Off-delay: q turns true at once and false once the input has held false for ``pt``."""
    return _timer(df, False, keys, ts, seq, input_col, pt, as_of_ns, width)


def watchdog(
    df: DataFrame,
    failsafe: str,
    keys: Sequence[str] = ("device",),
    ts: str = "ts_ns",
    seq: str = "seq",
    timeout: str = "timeout",
    data_col: str = "data",
    as_of_ns: int | None = None,
    width: str | int = SLICE,
) -> DataFrame:
    """Every row, plus one failsafe row at ``ts + timeout`` where no row followed in time.

    The failsafe row carries only the key, the time and the failsafe text.
    """
    if not failsafe.strip():
        raise ValueError("failsafe is required")
    usable, _ = control_failures(df, timeout)
    rows = Ordered.of(usable, keys, [ts, seq], width)
    rows = rows.add(_next=rows.following(F.col(ts)))
    alarm_at = F.col(ts) + F.col("_ms") * NS_PER_MS
    fires = (F.col("_ms") > 0) & (F.col("_next").isNull() | (F.col("_next") > alarm_at))
    if as_of_ns is not None:
        fires = fires & (alarm_at <= as_of_ns)
    own = df.columns
    types = dict(df.dtypes)
    echo = F.struct(*[F.col(c) for c in own], F.lit("input").alias("kind"))
    alarm = F.struct(
        *[
            (
                F.col(c) if c in keys
                else alarm_at.cast(types[c]) if c == ts
                else F.lit(failsafe) if c == data_col
                else F.lit(None).cast(types[c])
            ).alias(c)
            for c in own
        ],
        F.lit("failsafe").alias("kind"),
    )
    return rows.df.select(F.inline(F.when(fires, F.array(echo, alarm)).otherwise(F.array(echo))))
