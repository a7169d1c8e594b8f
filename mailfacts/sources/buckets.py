"""Histories stored in buckets of the keys they are joined on, so that joins leave them where they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` as the catalog table ``table`` at ``path``, dealt into ``buckets`` by a hash of ``keys`` and
    sorted by them within each file.

    Rows are first gathered by bucket, so that a bucket is one file. The number of buckets stays with the
    table: take one at which a bucket fits in a task's memory. A hot key lies in one bucket, which is
    read in parts only by plans that do not use the buckets; reduce such a table by its keys first, as
    ``open_sends_bucketed`` does, where a key needs one row only.
    """
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
