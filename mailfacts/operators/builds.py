"""Reading one build of a build-versioned table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the folder name of a partition whose value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def stored_builds(df: DataFrame, build_column: str) -> DataFrame | None:
    """(build): the builds that a table partitioned by them has files of, null builds left out, or
    None for other tables.

    They are taken from the file listing that Spark holds of the table, within the JVM: no file is
    opened, and of the names one comes to Python.
    """
    folder = rf"/{re.escape(build_column)}=([^/]+)/"
    files = df._jdf.inputFiles()
    if not len(files) or not re.search(folder, files[0]):
        return None
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files)
    listed = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    # Folder names escape characters, and the addresses of files escape once more.
    value = _unescaped(_unescaped(F.regexp_extract("value", folder, 1)))
    kind = df.schema[build_column].dataType
    builds = DataFrame(listed, spark).select(value.alias("build")).where(F.col("build") != NULL_PARTITION)
    return builds.select(F.col("build").cast(kind).alias("build")).distinct()


def _unescaped(value: Column) -> Column:
    """Undo escapes like %3A. A plus stands for itself, other than in forms."""
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def _newest(df: DataFrame, build_column: str) -> Column:
    builds = stored_builds(df, build_column)
    if builds is None:
        return df.select(F.max(build_column)).scalar()
    newest = builds.select(F.max("build").cast("string")).first()[0]
    return F.lit(newest).cast(df.schema[build_column].dataType)


def latest_build(df: DataFrame, build_column: str = "build_ts") -> DataFrame:
    """Rows of the newest build; an empty table gives an empty result, and a null build is never
    the newest.

    On a table partitioned by the build the newest one is known from its folders, by a job over their
    names alone, and prunes the scan as a literal. On other tables it is a scalar subquery over the build column alone, which reads that
    column of all builds.
    """
    return df.where(F.col(build_column) == _newest(df, build_column))
