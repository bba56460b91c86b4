"""Session settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# UTC: event times are epoch based. LAST_WIN: a later JSON key, point or mapping
# pair of the same name replaces the earlier one. Skew join and rebalancing stay
# on so that one hot device cannot hold up a join or a write.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows may hold long texts; a batch of them has to fit in a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Shuffles begin with many partitions, and adaptive execution merges neighbours up to a small
# size. So what one task sorts or aggregates follows that size and not the table, whatever
# number of shuffle partitions the session has.
FINE_SHUFFLES = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
# What a rebalance before a write aims at instead, so that files do not become small.
WRITE_SIZE = "64m"
# Names, in the session, the settings of these that are ours and not the session's own.
_FINE = "tagflow.fineShuffles"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def fine_shuffles(spark: SparkSession, on: bool = True) -> SparkSession:
    """Shuffles in small parts, or no longer; numbers that the session gives itself stay."""
    ours = [key for key in spark.conf.get(_FINE, "").split(",") if key]
    if on and not ours:
        ours = [key for key in FINE_SHUFFLES if spark.conf.get(key, None) is None]
        for key in ours:
            spark.conf.set(key, FINE_SHUFFLES[key])
        spark.conf.set(_FINE, ",".join(ours))
    elif not on and ours:
        for key in ours:
            spark.conf.unset(key)
        spark.conf.unset(_FINE)
    return spark


@contextmanager
def write_sized(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffles are merged up to the size of files, where the small size is ours."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    ours = key in spark.conf.get(_FINE, "").split(",")
    if ours:
        spark.conf.set(key, WRITE_SIZE)
    try:
        yield
    finally:
        if ours:
            spark.conf.set(key, FINE_SHUFFLES[key])


def build_session(app: str = "tagflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return fine_shuffles(configure(builder.getOrCreate()))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session (``spark.checkpoint.dir``) or set by the caller."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(named)
    return named


def ship_by_value(*modules: str) -> None:
    """Send code of these packages inside each task instead of by module name.

    Workers (also the one that starts a stateful stream on the driver) then need
    no installed copy. Where the package is installed on every node, skip it.
    """
    for name in ("tagflow", *modules):
        cloudpickle.register_pickle_by_value(importlib.import_module(name))
