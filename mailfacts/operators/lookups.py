"""Point look-ups: few keys in a table of billions of rows, without reading or shuffling it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.operators.attribution import tracked_clicks, tracked_links
from mailfacts.operators.dedupe import keep_matching
from mailfacts.session import FREE_SHUFFLES, LIST_PIECE, MOST_LOOKED_UP, during

# Writing: rows of a row group, for which Bloom filters are sized.
GROUP_ROWS = 1_000_000


def write_for_lookups(
    df: DataFrame, path: str, key: str, mode: str = "append", group_rows: int = GROUP_ROWS, **options: str
) -> None:
    """Write ``df`` sorted by ``key`` within files, with a Bloom filter of it in every row group.

    A daily load appends files of its own. Keys lie anywhere in each of them, so the statistics of a
    file say nothing; those of a sorted row group and the Bloom filter do.
    """
    (
        df.sortWithinPartitions(key)
        .write.mode(mode)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(group_rows))
        .options(**options)
        .parquet(path)
    )


def few_values(df: DataFrame, column: str, at_most: int = MOST_LOOKED_UP) -> list[Any] | None:
    """The distinct values of ``column``, null left out, or None if there are more than ``at_most``.

    Runs a job, which brings at most one value more than that to the driver.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    with during(df.sparkSession, FREE_SHUFFLES):
        found = values.limit(at_most + 1).collect()
    return None if len(found) > at_most else [row[0] for row in found]


def among(column: str, values: Sequence[Any]) -> Column:
    """Whether ``column`` is one of ``values``, in a form that Parquet compares with every row group.

    Spark hands Parquet a list as a chain of comparisons, which is walked recursively: thousands of links end
    in a stack overflow. Lists beyond ``session.LIST_PIECE`` are handed over as one range, and beside it
    as a balanced tree of lists that short. Rows are first tested against the whole list, so few meet the tree.
    """
    key = F.col(column)
    whole = key.isin(list(values))
    if len(values) <= LIST_PIECE:
        return whole
    pieces = [key.isin(list(values[i : i + LIST_PIECE])) for i in range(0, len(values), LIST_PIECE)]
    while len(pieces) > 1:
        pairs = zip(pieces[::2], pieces[1::2])
        pieces = [a | b for a, b in pairs] + pieces[len(pieces) // 2 * 2 :]
    return whole & pieces[0]


def looked_up(
    table: DataFrame, keys_of: DataFrame, key: str, at_most: int = MOST_LOOKED_UP
) -> DataFrame:
    """Rows of ``table`` whose ``key`` occurs in ``keys_of``.

    Few keys become a list that Parquet compares with statistics and Bloom filters, so that row groups
    without any of them are skipped. More keys are joined.
    """
    values = few_values(keys_of, key, at_most)
    if values is None:
        return keep_matching(table, keys_of, [key])
    return table.where(among(key, values))


def tracked_clicks_looked_up(
    clicks: DataFrame, tracking: DataFrame, success: DataFrame, at_most: int = MOST_LOOKED_UP
) -> DataFrame:
    """``tracked_clicks`` for a run of few clicks: their links are looked up among all links ever mailed,
    then the queue rows of those links."""
    links = looked_up(tracking, tracked_links(clicks), "trackingcode", at_most)
    queued = looked_up(success, links, "emailqueuesuccessid", at_most)
    return tracked_clicks(clicks, links, queued)
