"""Small helpers shared by the tests."""

from __future__ import annotations

import re
from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def rows(df: DataFrame, *columns: str) -> Counter:
    """The rows as a multiset."""
    return Counter(tuple(row) for row in (df.select(*columns) if columns else df).collect())


def frame(spark: SparkSession, schema: str, *data: tuple) -> DataFrame:
    return spark.createDataFrame(list(data), schema)


def planned(df: DataFrame) -> str:
    """The plan Spark would start with."""
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df: DataFrame) -> tuple[list, str]:
    """The rows of ``df`` and the plan Spark ended with."""
    result = df.collect()
    return result, planned(df).split("+- == Initial Plan ==")[0]


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))
