from __future__ import annotations

from pyspark.sql import functions as F

from tagflow.session import fine_shuffles, write_sized

FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def test_tasks_behind_a_shuffle_follow_the_rows(spark):
    """More rows give more tasks than the session's eight shuffle partitions."""

    def tasks(rows):
        keyed = spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).groupBy("k").count()
        return keyed.select(F.spark_partition_id().alias("p")).distinct().count()

    before = spark.conf.get(SIZE)
    spark.conf.set(SIZE, "64k")
    spark.conf.set(LEAST, "1k")
    try:
        few, many = tasks(2_000), tasks(100_000)
        assert few < 16 < many
    finally:
        spark.conf.set(SIZE, before)
        spark.conf.unset(LEAST)


def test_numbers_of_the_session_stay(spark):
    other = spark.newSession()
    for key in (FIRST, SIZE, "tagflow.fineShuffles"):
        other.conf.unset(key)
    plain = other.conf.get(SIZE)
    fine_shuffles(other)
    assert (other.conf.get(FIRST), other.conf.get(SIZE)) == ("200", "8m")
    with write_sized(other):
        assert other.conf.get(SIZE) == "64m"
    assert other.conf.get(SIZE) == "8m"
    fine_shuffles(fine_shuffles(other), on=False)
    assert other.conf.get(FIRST, None) is None and other.conf.get(SIZE) == plain
    other.conf.set(SIZE, "8m")
    fine_shuffles(fine_shuffles(other), on=False)
    assert other.conf.get(SIZE) == "8m" and other.conf.get(FIRST, None) is None
    with write_sized(fine_shuffles(other)):
        assert other.conf.get(SIZE) == "8m"
