"""Keeping one row per key, always the same one, and keeping rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailfacts.functions import key_tag


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``latest_by`` values of every key, nulls last.

    The remaining columns break ties, so rows that still tie are identical and the survivor
    does not depend on how the data was partitioned. Spark keeps only the leading row of each
    key in every input partition before it shuffles, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in set(latest_by) | set(keys)]
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_per_key_aggregate(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]
) -> DataFrame:
    """``latest_per_key`` as an aggregate: the greatest of all rows of a key, in which null comes first.

    Partially aggregated, so a hot key sends one row per task here too. Its buffer holds whole rows,
    for which Spark sorts by key in every task instead of hashing. Not measured beside the window yet.
    """
    rest = [c for c in df.columns if c not in set(latest_by) | set(keys)]
    row = F.max(F.struct(*latest_by, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct values of ``keys``, ready to be joined on them (see ``key_tag``)."""
    tagged = df.select(*keys, key_tag(*keys).alias("_distinct_tag"))
    return tagged.distinct().drop("_distinct_tag")


def keep_matching(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``keys_of``.

    Cuts a long history to what a short run can attribute, before it is reduced or joined.
    The distinct keys are broadcast where Spark finds them small enough, and both sides are
    shuffled, with hot keys split, where it does not.
    """
    return df.join(distinct_keys(keys_of, keys), list(keys), "left_semi").select(*df.columns)
