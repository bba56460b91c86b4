"""Sharding documents into contiguous runs of near equal bytes.

Equal texts stay together: an atom is the group of rows whose text has one 64-bit hash,
and atoms are ordered by that hash. The smallest shard capacity for which a greedy pass
over the ordered atoms fills no more than the given number of shards is found by binary
search, and the greedy pass at that capacity gives the cuts. An atom that outweighs an
even share of what is left gets a shard of its own first, largest first; the others share
the remaining shards, so one huge group does not loosen the capacity of all.

The search does not read the atoms. It works on segments of the hash space with their
bytes: at first 2 ** `TOP_BITS`, then those that a cut may fall in are split further, in
one aggregation each time, until the capacity and all cuts are exact. Bounds on the cuts
come from the same greedy pass: cuts at the start of an unsplit segment are lower bounds,
cuts anywhere inside it are upper ones, and both grow with the capacity. The driver holds
at most some `MOST_SEGMENTS` sums, whatever the number of documents.

Defined cases: a null text has no bytes and is of one group with empty texts; repeated
rows take a slot each; slots follow hash, then doc_id (null first); with fewer atoms than
shards some shards stay empty; an empty table gives an empty result; texts count in
whole; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tagflow.llm.common import cut, ranked

SHARDS = 40
ROW_BYTES = 16
TOP_BITS = 16
MOST_SEGMENTS = 1 << 18

LOW = -(1 << 63)


class Segments:
    """Ordered runs of the hash space: `lo` (hash from which they run), `bits` of width, bytes, whether one atom."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows = sorted(rows)
        self.lo = [r[0] for r in rows]
        self.bits = np.array([r[1] for r in rows], np.int64)
        self.bytes = np.array([r[2] for r in rows], np.int64)
        self.single = np.array([r[3] == 1 for r in rows], bool)
        self.before = np.concatenate(([0], np.cumsum(self.bytes)))

    @property
    def total(self) -> int:
        return int(self.before[-1])

    def _cuts(self, capacity: int, shards: int, least: bool) -> list[int]:
        """Where the greedy pass ends each shard, in bytes: a lower or an upper bound."""
        out, at = [], 0
        for _ in range(shards):
            to = min(at + capacity, self.total)
            i = int(np.searchsorted(self.before, to, "right")) - 1
            inside = i < len(self.bytes) and to > self.before[i]
            at = int(self.before[i]) if inside and (least or self.single[i]) else to
            out.append(at)
        return out

    def _smallest(self, low: int, high: int, shards: int, least: bool) -> int:
        """The smallest capacity at which the bound reaches the end."""
        while low < high:
            middle = (low + high) // 2
            if self._cuts(middle, shards, least)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def search(self, largest: int, shards: int) -> tuple[int, list[int], np.ndarray]:
        """(capacity known to do, its cuts in bytes, segments to split until it is the smallest and exact)."""
        low = max(largest, -(-self.total // shards), 1)
        does = self._smallest(low, max(low, self.total), shards, True)
        may = self._smallest(low, does, shards, False)
        first, last = self._cuts(may, shards, True), self._cuts(does, shards, False)
        touched = np.zeros(len(self.bytes), bool)
        for a, b in zip(first[:-1], last[:-1]):
            if a < b:
                touched |= (self.before[:-1] < b) & (self.before[1:] > a)
        return does, self._cuts(does, shards, True), np.flatnonzero(touched & ~self.single)


def _segments(atoms: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
    """(lo, bits, bytes, atoms) of the segments of that width; a bounded number by the caller's choice."""
    at = F.shiftright("h", bits)
    rows = atoms.groupBy(at.alias("at")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    return [(r["at"] << bits, bits, r["bytes"], r["n"]) for r in rows]


def cuts(atoms: DataFrame, shards: int, largest: int, top_bits: int = TOP_BITS, most: int = MOST_SEGMENTS) -> list[int]:
    """Hashes at which the second and each further shard begins; atoms (h, bytes), one row each."""
    spark = atoms.sparkSession
    known = _segments(atoms, 64 - top_bits)
    while True:
        now = Segments(known)
        _, ends, split = now.search(largest, shards)
        if not len(split):
            break
        finer = max(1, int(np.log2(max(2, (most - len(known)) // len(split)))))
        made = []
        for bits in sorted({int(now.bits[i]) for i in split}):
            chosen = [now.lo[i] >> bits for i in split if now.bits[i] == bits]
            inside = spark.createDataFrame([(x,) for x in chosen], "at long")
            # Bounded by MOST_SEGMENTS rows of one number.
            near = atoms.join(F.broadcast(inside), F.shiftright("h", bits) == F.col("at"), "left_semi")
            made += _segments(near, max(0, bits - finer))
        gone = {now.lo[i] for i in split}
        known = [k for k in known if k[0] not in gone] + made
    starts = np.searchsorted(now.before, ends[:-1], "left")
    return [now.lo[i] if i < len(now.lo) else (1 << 63) - 1 for i in starts if i < len(now.lo)]


def _apart(top: list[tuple[int, int]], total: int, shards: int) -> list[tuple[int, int]]:
    """Of the largest atoms (h, bytes), largest first: those that get a shard of their own."""
    out = []
    for h, size in top:
        if shards - len(out) < 2 or size * (shards - len(out)) <= total:
            break
        out.append((h, size))
        total -= size
    return out


def assign(docs: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES, key: str = "doc_id", text: str = "text",
           top_bits: int = TOP_BITS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 within the shard); one row per row."""
    body = F.coalesce(text, F.lit(""))
    rows = cut(docs.select(
        key, (F.octet_length(body) + row_bytes).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.xxhash64(body).alias("h"),
    ))
    atoms = cut(rows.groupBy("h").agg(F.sum("size").alias("bytes")))
    total = atoms.agg(F.sum("bytes")).first()[0] or 0
    # At most one atom a shard can outweigh an even share; the next one is the largest of the rest.
    top = [(r["h"], r["bytes"]) for r in atoms.orderBy(F.desc("bytes"), "h").limit(shards).collect()]
    own = _apart(top, total, shards)
    rest = atoms.where(~F.col("h").isin([h for h, _ in own])) if own else atoms
    largest = top[len(own)][1] if len(top) > len(own) else 0
    borders = cuts(rest, shards - len(own), largest, top_bits) if largest else []
    return _placed(rows, [h for h, _ in own], borders).select(key, "size", "text_crc32", "shard", "slot")


def _placed(rows: DataFrame, own: list[int], borders: list[int]) -> DataFrame:
    passed = lambda: F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= F.col("h"))) if borders else F.lit(0)
    shard: Column = passed() + len(own)
    for i, h in enumerate(own):
        shard = F.when(F.col("h") == h, i).otherwise(shard)
    return ranked(rows.withColumn("shard", shard.cast("int")), ["shard"], ["h", *[c for c in rows.columns[:1]]], "slot")
