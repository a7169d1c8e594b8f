"""Session settings the plans are written for."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Keys that are looked up in a stored table as a list.
MOST_LOOKED_UP = 10_000
# Values of a list that Parquet gets as they are. It walks them recursively, one call for each.
LIST_PIECE = 100

# Runtime SQL settings; everything else is left to Spark and to whoever runs the cluster.
SETTINGS = {
    # Wall-clock values are stored without a zone, so nothing may depend on the local one.
    "spark.sql.session.timeZone": "UTC",
    # Re-planning at run time picks broadcast joins by measured size, coalesces small
    # partitions and splits hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later distinct reuses the join's partitioning.
    # Costs one exchange, and only when a hot key has been measured.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where every partition of one side has been measured to fit. Measured is
    # the compressed shuffle; the hash table, which cannot spill, takes several times as much of
    # a task's memory: allow 512 MB for each task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # A long tracking or send table meets a short run through a Bloom filter of the run's keys,
    # which Spark adds by itself where the long side is large enough to be worth it.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # Short lists of keys reach the row groups of Parquet as they are, not as one range. Longer ones come
    # in pieces (``operators.lookups.among``).
    "spark.sql.parquet.pushdown.inFilterThreshold": str(LIST_PIECE),
    # Overwrites replace only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# To be given when a session is created.
STATIC_SETTINGS = {
    # Plans consist of thousands of column calls; noting the call site of each would take
    # longer than building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A fact plan generates more classes than the default cache holds, so that repeated runs
    # would compile and warm up all of them anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# For actions whose plan is not run again: their shuffles leave the disk when they end, not when the driver
# happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Sizing of shuffles by the volume of the inputs.
PARTITION_BYTES = 256 * 1024 * 1024
UNKNOWN_BYTES = 1 << 62
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def during(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for the actions started within, and as they were before after that."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables a plan reads, each as often as it reads it.

    From what Spark knows of its sources when it analyses a plan; starts no job. Sources whose size it
    does not know count nothing.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def size_shuffles(df: DataFrame) -> DataFrame:
    """Let the shuffles of ``df`` start with so many partitions that each fits in memory, even if
    one shuffle should move all that the plan reads.

    Adaptive execution joins partitions that turn out small, while too few could not be mended. So the
    number is never lowered: a plan built before another and run after it keeps enough.
    """
    spark = df.sparkSession
    needed = -(-input_bytes(df) // PARTITION_BYTES)
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = int(spark.conf.get(INITIAL_PARTITIONS, None) or 0)
    spark.conf.set(INITIAL_PARTITIONS, str(max(needed, present, before)))
    return df


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine session without
    that setting falls back to a new folder below ``/tmp``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return os.path.join(named, "mailfacts")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="mailfacts-", dir="/tmp")
