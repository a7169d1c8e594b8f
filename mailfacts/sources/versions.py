"""Partitioned tables to which a run only ever adds.

Layout below the table's folder: ``data/run=<run>/<partition columns>/`` holds the rows a run has
written, ``commits/run=<run>/`` lists the partitions it stands for. The list is written last, as one
file. A reader takes of every partition the newest run that lists it: a join of the data with the
small list of folders. So nothing is renamed or deleted in the driver after a job, readers never see
half a run, a run that was killed leaves the table as it was, a run may read the table it adds
to, and older states stay readable.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailfacts.operators.conform import conform
from mailfacts.operators.lookups import few_values
from mailfacts.session import FREE_SHUFFLES, during
from mailfacts.sources.sink import write_partitioned

RUN = "run"
_CHOSEN = "_chosen_"


def new_run() -> str:
    """A name that sorts after those of earlier runs, and of no other run."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"


def add_run(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str],
    run: str | None = None,
    emptied: DataFrame | None = None,
) -> str:
    """Add a run that replaces, for readers, the partitions ``df`` has rows for. Returns its name.

    Partitions in ``emptied`` (the partition columns) that get no row become empty. All other partitions
    stay as they are. A run of the same name must not have been added before.
    """
    run = run or new_run()
    spark = df.sparkSession
    folder = f"{path}/data/{RUN}={run}"
    write_partitioned(conform(df, schema), folder, partitions, mode="errorifexists")
    listed = spark.read.schema(schema).parquet(folder).select(*partitions)
    if emptied is not None:
        listed = listed.unionByName(emptied.select(*partitions))
    with during(spark, FREE_SHUFFLES):
        listed.distinct().coalesce(1).write.mode("errorifexists").parquet(f"{path}/commits/{RUN}={run}")
    return run


def committed(
    spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str]
) -> DataFrame:
    """(run, partition columns): what each finished run stands for."""
    fields = [schema[name] for name in partitions]
    listed = T.StructType([*fields, T.StructField(RUN, T.StringType())])
    return spark.read.schema(listed).parquet(f"{path}/commits")


def newest_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str],
    as_of: str | None = None,
) -> DataFrame:
    """(partition columns, run): the newest finished run of each partition, up to ``as_of``."""
    runs = committed(spark, path, schema, partitions)
    if as_of is not None:
        runs = runs.where(F.col(RUN) <= as_of)
    return runs.groupBy(*partitions).agg(F.max(RUN).alias(RUN))


def read_newest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str],
    as_of: str | None = None,
) -> DataFrame:
    """The table as its finished runs leave it, up to the run ``as_of`` if one is given.

    Filters on partition columns prune folders while the query is planned, and so do the names of the runs
    that something is still taken from. A small job reads those from the list of folders first; if there
    should be very many, the join with the list alone decides.
    """
    stored = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(stored).parquet(f"{path}/data")
    newest = newest_partitions(spark, path, schema, partitions, as_of)
    live = few_values(newest, RUN)
    if live is not None:
        rows = rows.where(F.col(RUN).isin(live))
    newest = newest.withColumnsRenamed({name: _CHOSEN + name for name in newest.columns})
    same = F.col(RUN) == F.col(_CHOSEN + RUN)
    for name in partitions:
        # A null partition value is a partition like any other.
        same &= F.col(name).eqNullSafe(F.col(_CHOSEN + name))
    return rows.join(newest, same, "left_semi").select(*schema.names)
