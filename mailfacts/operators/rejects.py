"""Typing text columns without letting one malformed value end the job.

Rows keep all their columns; what could not be typed is null and named in ``reject_reason``, which is null
for good rows. So good rows and rejects come out of one pass: write the result once, partitioned by
whether there is a reason, or take both parts from a stored copy.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "reject_reason"
RECORD = "reject_record"


def _malformed(name: str, kind: str) -> Column:
    """The reason why a value that is there cannot be of type ``kind``, or null."""
    bad = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
    return F.when(bad, F.concat(F.lit(f"{name} is no {kind}: "), F.col(name)))


def cast_with_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with the named text columns typed, and the reasons of rows where that failed.

    All reasons of a row are given, in the order of ``types``. Null values are no failures, and
    blanks around a value no malformation, as in Spark's casts.
    """
    reasons = F.concat_ws("; ", *(_malformed(name, kind) for name, kind in types.items()))
    marked = df.withColumn(REASON, F.nullif(reasons, F.lit("")))
    return marked.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV file in the given schema, whose names and order the header must have. Lines with values
    that do not fit it, or with too few or too many values, have ``reject_reason`` set and the line in
    ``reject_record``; a header that differs is one of them. Values may not contain line breaks.

    Lines are parsed by an expression, as the file source looks for malformed values only in the columns
    a query goes on to use.
    """
    full = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    header = F.regexp_replace("value", '["\\s]', "") == ",".join(schema.names)
    parsed = F.from_csv("value", full.toDDL(), options)
    rows = spark.read.text(path).where(~header).select(parsed.alias("_row")).select("_row.*")
    return rows.withColumn(REASON, F.when(F.col(RECORD).isNotNull(), "malformed line"))


def good_rows(marked: DataFrame) -> DataFrame:
    """The rows without a reason, in their own columns."""
    return marked.where(F.col(REASON).isNull()).drop(REASON, RECORD)


def rejected_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REASON).isNotNull())
