"""Writing results into partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mailfacts.operators.conform import conform
from mailfacts.session import FREE_SHUFFLES, during

# A task writes its partitions one after the other, each for some milliseconds at least. Thousands of
# nearly empty ones must not be gathered in one task just because together they are small.
_WRITE_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB"}
# Halves the hexadecimal keys of the facts, which the default codec leaves as they are.
_CODEC = "zstd"


def _sized_for_partitions(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather each output partition into files of Spark's advisory size.

    Small partitions share a task and a large one is spread over many, so that neither a
    fixed number of writers nor one big day limits the write.
    """
    return df.hint("rebalance", *partitions)


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], mode: str, **options: str
) -> None:
    """Write ``df`` below ``path``, a folder for each value of the partition columns."""
    with during(df.sparkSession, _WRITE_SETTINGS | FREE_SHUFFLES):
        (
            _sized_for_partitions(df, partitions)
            .write.mode(mode)
            .options(**{"compression": _CODEC} | options)
            .partitionBy(*partitions)
            .parquet(path)
        )


def replace_partitions(
    df: DataFrame, path: str, schema: T.StructType, partitions: Sequence[str]
) -> None:
    """Replace, in the Parquet table at ``path``, the partitions ``df`` has rows for.

    All other partitions stay. A partition that no longer gets any row is not emptied. All rows
    are computed before any old file is removed, so ``df`` may have been read from the same
    table. The partitions are then exchanged one after the other: a driver lost just then leaves
    some replaced and some not. ``sources.versions`` has tables without that step.
    """
    write_partitioned(
        conform(df, schema), path, partitions, "overwrite", partitionOverwriteMode="dynamic"
    )


def replace_table_partitions(
    df: DataFrame, table: str, schema: T.StructType, partitions: Sequence[str]
) -> None:
    """The same for a catalog table, which inserts by position: ``schema`` gives the order.

    Needs ``spark.sql.sources.partitionOverwriteMode=dynamic`` (see ``session.SETTINGS``);
    otherwise the insert would replace the whole table.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise ValueError("partitionOverwriteMode must be dynamic, or all partitions are lost")
    rows = _sized_for_partitions(conform(df, schema), partitions)
    rows.write.insertInto(table, overwrite=True)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, partitions: Sequence[str]
) -> None:
    """Create an empty partitioned Parquet table, if there is none, for the insert above."""
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        empty.write.partitionBy(*partitions).format("parquet").saveAsTable(table)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table written above. The given schema keeps dates in partition names text."""
    return spark.read.schema(schema).parquet(path)
