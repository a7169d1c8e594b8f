"""Reading, storing and batching shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from mailfacts.session import scratch_dir

# The two kinds of words: runs without ASCII white space, and runs of letters and digits after
# lower-casing, where every byte beyond ASCII counts as a letter.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows and bytes that Spark hands to a Python worker at once, and bytes of text that the
# vectorised operators work on at once (or one text, where that is longer).
BATCH_ROWS = 2_000
BATCH_BYTES = 32 * 1024 * 1024
CHUNK_BYTES = 2 * 1024 * 1024

# Measured size up to which a side is broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for Python tasks: small batches, so that long texts do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later plans start from files
    that outlive any executor, with sizes the optimizer knows."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` (texts by their length, all else eight bytes), by one aggregate."""
    width = F.lit(0)
    for field in df.schema:
        long = isinstance(field.dataType, StringType | BinaryType)
        width = width + 8 + (F.coalesce(F.octet_length(field.name), F.lit(0)) if long else 0)
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def small_side(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it measures at most ``BROADCAST_BYTES``. Beyond
    that Spark joins by shuffling, and splits hot keys."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. A null id falls into fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z only, unlike ``lower``."""
    return F.translate(column, UPPER, LOWER)


_PLAIN = bytes(
    ord(" ") if c < 0x30 or 0x3A <= c < 0x41 or 0x5B <= c < 0x61 or 0x7B <= c < 0x80
    else c + 32 if 0x41 <= c <= 0x5A
    else c
    for c in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """The lower-cased letter-and-digit words of ``PLAIN_WORD``, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``CHUNK_BYTES`` of text, or one longer row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        first = total = 0
        for i, size in enumerate(sizes):
            if i > first and total + size > CHUNK_BYTES:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if first < len(sizes):
            yield batch.slice(first)
