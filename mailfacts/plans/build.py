"""Columns that describe the run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def build_time(build_ts: str) -> Column:
    return F.lit(build_ts).cast("timestamp_ntz")
