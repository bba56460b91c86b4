"""Row order inside a key, as one plan for keys of every size.

``lag``, ``lead`` and running values need the rows of a key in order. Rows fall in
slices (key, time divided by a fixed width), and windows run inside a slice only, so a
key that holds any share of all rows is spread over as many tasks as it has slices.
What crosses a slice's border is handed over by a segmented prefix scan: a slice gives
a summary that can be combined (its last row, its newest known value, its sum), a window
over the summaries of a key gives what each slice begins with, and an equi-join on
(key, slice) brings that to the rows.

Building a plan starts no job, and the plan does not depend on the data. The largest
task sorts one slice of one key: choose the width so that the rows of the busiest key
in that time fit. A null order value has a slice of its own, before all others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions.stages import join_on
from tagflow.functions.text import parse_duration_ms

# Time of one slice, as a duration.
SLICE = "1h"

_SLICE = "_slice"
_BEFORE = (Window.unboundedPreceding, -1)


def slice_of(df: DataFrame, column: str, width: str | int) -> Column:
    """Number of the slice a row is in: ``width`` is a duration for times (timestamps, or
    nanoseconds in a bigint), or a plain number in the units of the column."""
    kind = dict(df.dtypes)[column]
    if isinstance(width, str):
        ms = parse_duration_ms(width)
        if not ms or ms < 0:
            raise ValueError(f"invalid slice {width!r}")
        width = ms * (1_000 if kind.startswith("timestamp") else 1_000_000)
    value = F.unix_micros(column) if kind.startswith("timestamp") else F.col(column).cast("bigint")
    step = F.lit(width).cast("bigint")
    # The remainder is taken off first, so that times before the epoch fall downwards.
    return F.call_function("div", value - F.pmod(value, step), step)


@dataclass(frozen=True)
class Value:
    """One ordered value: what a row sees in its slice, what a slice hands over, and both together."""

    local: Column
    summary: Column
    entry: Callable[[Column], Column]
    backwards: bool
    merge: str


@dataclass(frozen=True)
class Ordered:
    """A frame whose rows have a total order inside each key."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], width: str | int = SLICE) -> Ordered:
        return cls(df.withColumn(_SLICE, slice_of(df, order[0], width)), tuple(keys), tuple(order))

    # -- plain frame operations that keep the slices ----------------------------

    def with_column(self, name: str, value: Column) -> Ordered:
        return replace(self, frame=self.frame.withColumn(name, value))

    def filter(self, condition: Column) -> Ordered:
        return replace(self, frame=self.frame.filter(condition))

    @property
    def df(self) -> DataFrame:
        return self.frame.drop(_SLICE)

    # -- ordered values ----------------------------------------------------------

    def window(self, backwards: bool = False):
        order = [F.col(c).desc() if backwards else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.keys, _SLICE).orderBy(*order)

    def across(self, backwards: bool = False):
        order = F.col(_SLICE).desc() if backwards else F.col(_SLICE).asc()
        return Window.partitionBy(*self.keys).orderBy(order)

    def edge(self, value: Column, known: Column | None, backwards: bool) -> Column:
        """Summary of a slice: the value of its last row (its first one backwards) of those known."""
        at = F.struct(*[F.col(c) for c in self.order])
        at = at if known is None else F.when(known, at)
        return F.min_by(value, at) if backwards else F.max_by(value, at)

    def _neighbour(self, value: Column, backwards: bool) -> Value:
        boxed = F.struct(value.alias("v"))
        return Value(
            F.lag(boxed).over(self.window(backwards)), self.edge(boxed, None, backwards),
            lambda s: F.lag(s).over(self.across(backwards)), backwards, "first",
        )

    def previous(self, value: Column) -> Value:
        """Value of the row before."""
        return self._neighbour(value, backwards=False)

    def following(self, value: Column) -> Value:
        """Value of the row after."""
        return self._neighbour(value, backwards=True)

    def _known(self, value: Column, backwards: bool, here: bool) -> Value:
        boxed = F.when(value.isNotNull(), F.struct(value.alias("v")))
        rows = self.window(backwards).rowsBetween(Window.unboundedPreceding, Window.currentRow if here else -1)
        return Value(
            F.last(boxed, ignorenulls=True).over(rows), self.edge(boxed, value.isNotNull(), backwards),
            lambda s: F.last(s, ignorenulls=True).over(self.across(backwards).rowsBetween(*_BEFORE)), backwards, "first",
        )

    def newest(self, value: Column) -> Value:
        """Newest non-null value up to and including this row."""
        return self._known(value, backwards=False, here=True)

    def upcoming(self, value: Column) -> Value:
        """First non-null value strictly after this row."""
        return self._known(value, backwards=True, here=False)

    def total(self, value: Column, peers: bool = False) -> Value:
        """Sum of a bigint up to and including this row; with ``peers`` rows of equal order count together."""
        w = self.window()
        frame = (Window.unboundedPreceding, Window.currentRow)
        rows = w.rangeBetween(*frame) if peers else w.rowsBetween(*frame)
        return Value(
            F.coalesce(F.sum(value).over(rows), F.lit(0)), F.sum(value),
            lambda s: F.sum(s).over(self.across().rowsBetween(*_BEFORE)), False, "sum",
        )

    def largest_before(self, value: Column) -> Value:
        """Largest value of all rows before this one."""
        boxed = F.struct(value.alias("v"))
        return Value(
            F.max(boxed).over(self.window().rowsBetween(*_BEFORE)), F.max(boxed),
            lambda s: F.max(s).over(self.across().rowsBetween(*_BEFORE)), False, "greatest",
        )

    def hand_over(self, local: dict[str, Column], summary: dict[str, Column], entry: dict[str, Column]) -> Ordered:
        """The scan itself: adds the ``local`` columns, summarises each slice with the ``summary``
        aggregates of them, computes ``entry`` columns over the summaries of a key (one after the
        other, so they may use each other) and joins those to the rows of the slice."""
        here = self.frame.withColumns(local) if local else self.frame
        slices = here.groupBy(*self.keys, _SLICE).agg(*[c.alias(n) for n, c in summary.items()])
        for n, c in entry.items():
            slices = slices.withColumn(n, c)
        handed = slices.select(*self.keys, _SLICE, *entry)
        return replace(self, frame=join_on(here, handed, [*self.keys, _SLICE], "left"))

    def add(self, **values: Value) -> Ordered:
        """The frame with ordered values as columns: all of them take one summary table and one join."""
        names = sorted(values, key=lambda n: values[n].backwards)
        over = self.hand_over(
            {f"_l_{n}": values[n].local for n in names},
            {f"_s_{n}": values[n].summary for n in names},
            {f"_e_{n}": values[n].entry(F.col(f"_s_{n}")) for n in names},
        )
        merged = []
        for n in values:
            local, entry = F.col(f"_l_{n}"), F.col(f"_e_{n}")
            if values[n].merge == "sum":
                merged.append((local + F.coalesce(entry, F.lit(0))).alias(n))
            elif values[n].merge == "greatest":
                merged.append(F.greatest(local, entry)["v"].alias(n))
            else:
                merged.append(F.coalesce(local, entry)["v"].alias(n))
        return replace(self, frame=over.frame.select(*self.frame.columns, *merged))


def row_number(rows: Ordered) -> Value:
    return rows.total(F.lit(1).cast("bigint"))
