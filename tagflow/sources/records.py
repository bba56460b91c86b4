"""Records of text files whose quoted values hold line ends.

A line's part depends on whether it begins inside a quoted value, and that on the line
before. So each line is read for both cases, and only the two possible states after it are
carried on: inside a block of a file by windows, from block to block by one row a block. A
file of any size is spread over as many tasks as it has blocks.

A record is joined only if every one of its lines fits: the first is readable up to a value
that stays open, the last closes it and ends like a record. If another line comes first that
cannot go on inside the value, or the file ends, nothing is joined and each of the lines
stands for itself. So a line with a stray quote takes another one with it only where the
two read as one faultless record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["_file", "_block"]


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, and where it stands: file, block (offset of a part of the file), place in the block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        # Rows of a block are read in order by one task.
        F.monotonically_increasing_id().alias("_at"),
    )


def _carried(outside: Column, inside: Column, window) -> tuple[Column, Column]:
    """States after each row for an entry outside and inside a value.

    ``outside`` and ``inside`` (0 or 1) are the states after the row alone for the two
    entries. Equal ones forget what came before; from there on only swaps count.
    """
    swaps = F.sum(F.when((outside == 1) & (inside == 0), 1).otherwise(0)).over(window)
    fixed = F.last(F.when(outside == inside, (outside + swaps) % 2), ignorenulls=True).over(window)
    return tuple(((F.coalesce(fixed, F.lit(entry)) + swaps) % 2).cast("int") for entry in (0, 1))


def whole_records(lines: DataFrame, opens: Column, goes_on: Column, closes: Column) -> DataFrame:
    """``value``: one record a row; lines as ``file_lines`` gives them.

    ``opens``: the line, read as the begin of a record, ends inside a quoted value.
    ``goes_on``: read from inside a value, it ends inside one. ``closes``: read from inside
    a value, it ends the record. The order of the result is free.
    """
    read = lines.withColumns({"_opens": opens.cast("int"), "_closes": closes & ~goes_on})
    read = read.withColumn("_breaks", ~goes_on & ~F.col("_closes"))
    inside = F.when(F.col("_breaks"), F.col("_opens")).when(F.col("_closes"), 0).otherwise(1)
    read = read.withColumn("_inside", inside)

    order = Window.partitionBy(*_BLOCK).orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = _carried(F.col("_opens"), F.col("_inside"), so_far)
    read = read.withColumns({"_after0": after[0], "_after1": after[1]})
    for entry in (0, 1):
        before = F.lag(f"_after{entry}", 1, entry).over(order)
        read = read.withColumn(f"_starts{entry}", (before == 0) | F.col("_breaks"))
    for entry in (0, 1):
        first = F.last(F.when(F.col(f"_starts{entry}"), F.col("_at")), ignorenulls=True).over(so_far)
        read = read.withColumn(f"_first{entry}", first)

    # One row a block: its end for both entries; then the entry of each block of a file.
    last = F.max_by(F.struct("_after0", "_after1", "_first0", "_first1"), "_at")
    blocks = read.groupBy(*_BLOCK).agg(last.alias("_end")).select(*_BLOCK, "_end.*")
    along = Window.partitionBy("_file").orderBy("_block")
    exits = _carried(F.col("_after0"), F.col("_after1"), along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    blocks = blocks.withColumn("_exit", exits[0]).withColumn("_entry", F.lag("_exit", 1, 0).over(along))
    newest = F.when(F.col("_entry") == 0, F.col("_first0")).otherwise(F.col("_first1"))
    blocks = blocks.withColumn("_newest", newest).select(
        *_BLOCK, "_entry",
        F.last("_newest", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
    )

    def of_entry(name: str) -> Column:
        return F.when(F.col("_entry") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    placed = read.join(blocks, _BLOCK).select(
        "value", *_BLOCK, "_at", "_closes", of_entry("_starts").alias("_starts"), of_entry("_after").alias("_after"),
        F.coalesce(of_entry("_first"), F.col("_earlier")).alias("_record"),
    )
    alone = F.col("_starts") & (F.col("_after") == 0)
    parts = placed.filter(~alone)
    # A record has one closing line at most, so this is one row a record.
    ends = parts.filter(~F.col("_starts") & F.col("_closes")).select("_file", "_record", F.lit(True).alias("_whole"))
    joined = (
        parts.join(ends, ["_file", "_record"], "left")
        .groupBy("_file", "_record", F.when(F.col("_whole").isNull(), F.col("_at")).alias("_own"))
        .agg(F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("_lines"))
        .select(F.array_join(F.col("_lines.value"), "\n").alias("value"))
    )
    return placed.filter(alone).select("value").unionByName(joined)


__all__ = ["file_lines", "whole_records"]
