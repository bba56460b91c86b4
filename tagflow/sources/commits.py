"""Which folders of a store are valid: a list of commits beside it, and compaction.

Every micro-batch has a folder of its own, and an entry in ``<store>-commits`` once the
folder is complete. Readers take the folders of the list only, so they never see a batch
that is half written. An entry stands for a range of batches; one that lies inside another
entry's range is out of use. Compaction writes the rows of several folders into one and adds
the entry of their range, which is what makes the new folder valid and the old ones not.

The list is one row a folder. It is read by the driver, which has to name the folders to
Spark; compaction and ``vacuum`` keep it short.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ENTRY = "first bigint, last bigint, level int, folder string, columns string"


@dataclass(frozen=True)
class Entry:
    """Batches ``first`` to ``last`` lie in ``folder``; ``level``: how often they were merged."""

    first: int
    last: int
    level: int
    folder: str
    columns: str

    def lies_in(self, other: Entry) -> bool:
        wider = other.last - other.first > self.last - self.first
        return wider and other.first <= self.first and self.last <= other.last


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}-commits"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """All entries of the list, in order of their batches; none if the store has no list."""
    files, target = _file_system(spark, _commits(path))
    if not files.exists(target):
        return []
    # Each entry is a folder of its own, so that adding one twice changes nothing.
    rows = spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(_commits(path)).collect()
    return sorted((Entry(*r) for r in rows), key=lambda e: (e.first, e.last))


def live(spark: SparkSession, path: str) -> list[Entry]:
    found = entries(spark, path)
    return [e for e in found if not any(e.lies_in(o) for o in found)]


def commit(spark: SparkSession, path: str, entry: Entry) -> None:
    row = (entry.first, entry.last, entry.level, entry.folder, entry.columns)
    made = spark.createDataFrame([row], ENTRY).coalesce(1)
    made.write.mode("overwrite").parquet(f"{_commits(path)}/{entry.first}-{entry.last}")


def read_committed(spark: SparkSession, path: str, chosen: list[Entry] | None = None) -> DataFrame | None:
    """Rows of the committed folders; None where the store has no list."""
    chosen = live(spark, path) if chosen is None else chosen
    if not chosen:
        return None
    # Batches without rows have no file to take the columns from; the newest entry has them all.
    columns = T.StructType.fromJson(json.loads(chosen[-1].columns))
    rows = spark.read.schema(columns).option("basePath", path).parquet(*[e.folder for e in chosen])
    return rows.drop("batch_id")


def compact(
    spark: SparkSession, path: str, write: Callable[[DataFrame, str], None], fan_in: int = 16
) -> list[Entry]:
    """Merge neighbouring folders of one level, ``fan_in`` at a time, until no level has as many.

    Rows are written anew once a level, so the number of times grows with the logarithm of
    the number of batches. ``write`` writes a frame into a folder. A run that is stopped
    leaves folders without an entry, which the next one overwrites. Returns the new entries.
    """
    if fan_in < 2:
        raise ValueError("at least two folders are merged")
    made = []
    while True:
        current = live(spark, path)
        run = next(
            (
                current[i : i + fan_in]
                for i in range(len(current) - fan_in + 1)
                if len({e.level for e in current[i : i + fan_in]}) == 1
            ),
            None,
        )
        if run is None:
            return made
        first, last = run[0].first, run[-1].last
        folder = f"{path}/batch_id={first}to{last}"
        write(read_committed(spark, path, run), folder)
        made.append(Entry(first, last, run[0].level + 1, folder, run[-1].columns))
        commit(spark, path, made[-1])


def vacuum(spark: SparkSession, path: str) -> list[Entry]:
    """Remove what compaction replaced: folders first, then their entries.

    For a time when no reader that began before the compaction is still at work.
    """
    kept = live(spark, path)
    gone = [e for e in entries(spark, path) if e not in kept]
    for entry in gone:
        for folder in (entry.folder, f"{_commits(path)}/{entry.first}-{entry.last}"):
            files, target = _file_system(spark, folder)
            files.delete(target, True)
    return gone


__all__ = ["Entry", "commit", "compact", "entries", "live", "read_committed", "vacuum"]
