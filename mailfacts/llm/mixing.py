"""Operator 2: mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a hashed order and read as one circular stream of words, cut
into blocks of equal length. The schedule is a row of slots: the golden-ratio sequence is mapped
through the cumulative shares of the sources, so every stretch of the schedule has each source
close to its share. The r-th slot of a source takes block r modulo its number of blocks.

Nothing here has one task per source: streams are laid out by (source, bucket of the hash) with
running offsets, slots are ranked by (source, stretch of slots) with running offsets. Only
windows over such totals, and over the one row per source, have one group per source or one in
all. Texts are read once, for their sizes.

Defined results: a null text has size 0; documents of size 0 are never taken; a null source is a
source of its own, the last; repeated rows are separate documents; without words all targets are
0. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailfacts.llm.common import SPACED_WORD, small_side, stored, text_or_empty

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 1024
# A source is cut into at least so many blocks (of a word at least), so that a few slots more or
# less do not matter.
LEAST_BLOCKS = 1000
BUCKET_ROWS = 1_000
SLOT_STRETCH = 4_096
GRID = 4_096
GOLDEN = (5**0.5 - 1) / 2


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size). ``key`` sorts like the source, null last, and is never null."""
    size = F.regexp_count(text_or_empty(), F.lit(SPACED_WORD)).cast("long")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))
    return docs.select("doc_id", "source", key.alias("key"), size.alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(key, words, target, length, blocks, share, low): one row per source.

    The level at which unlimited sources stand is found by repeated aggregates over the source
    table; each round fixes the sources that the level takes beyond their limit, so the level
    only rises and the rounds end.
    """
    order = Window.orderBy("key")  # over one row per source
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (rank % len(weights) + 1).cast("int"))
    sources = stored(
        sizes.groupBy("key").agg(F.sum("size").alias("words")).withColumn("weight", weight), "op2-sources"
    )
    limit = F.col("words") * MOST_REPEATS
    total = sources.agg(F.sum("words")).first()[0] or 0
    level = 0.0
    while total:
        over = limit < F.lit(level) * F.col("weight")
        fixed, rest = sources.agg(
            F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        new = (total - (fixed or 0)) / rest if rest else level
        if new <= level:
            break
        level = new
    length = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.expr(f"words div {LEAST_BLOCKS}"))).cast("long")
    slots = F.col("target") / F.greatest(F.col("words"), F.lit(1)) * F.col("blocks")
    running = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sources.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))
        .withColumn("length", length)
        .withColumn("blocks", F.ceil(F.col("words") / F.col("length")))
        .withColumn("share", slots)
        .withColumn("high", F.sum("share").over(running))
        .withColumn("low", F.col("high") - F.col("share"))
    )


def layout(sizes: DataFrame, sources: DataFrame, seed: int = 0) -> DataFrame:
    """Every document with its first word ``at`` in its source's shuffled stream."""
    rows = sizes.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    h = F.xxhash64(F.lit(seed), "doc_id")
    placed = sizes.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
        .select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    order = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "size")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        placed.select("doc_id", "source", "key", "size", "bucket", F.row_number().over(order).alias("row"), (inside - F.col("size")).alias("inside"))
        .join(stored(offsets, "op2-offsets"), ["key", "bucket"])
        .join(small_side(sources.select("key", F.col("words").alias("source_size"), "target", "length")), "key")
        .withColumn("at", F.col("offset") + F.col("inside"))
        .drop("offset", "inside")
    )


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, key, rank, block): which block each slot takes. Slots beyond the allowed repeats of
    a source, which rounding can add at the limit, stay empty."""
    spark = sources.sparkSession
    total = sources.agg(F.max("high")).first()[0] or 0.0
    slots = round(total)
    cell = F.sequence(
        F.floor(F.col("low") / total * GRID), F.least(F.floor(F.col("high") / total * GRID), F.lit(GRID - 1).cast("long"))
    )
    cells = sources.where("share > 0").select("key", "low", "high", "blocks", F.explode(cell).alias("cell")) if slots else (
        sources.where(F.lit(False)).select("key", "low", "high", "blocks", F.lit(0).cast("long").alias("cell"))
    )
    u = F.col("u")
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0)) * F.lit(total)).alias("u")
    )
    drawn = (
        points.withColumn("cell", F.least(F.floor(u / F.lit(total or 1.0) * GRID), F.lit(GRID - 1).cast("long")))
        .join(small_side(stored(cells, "op2-cells")), "cell")
        .where((u >= F.col("low")) & (u < F.col("high")))
        .select("slot", "key", "blocks", F.expr(f"slot div {SLOT_STRETCH}").alias("stretch"))
    )
    before = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        drawn.groupBy("key", "stretch").agg(F.count("*").alias("n"))
        .select("key", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("key", "stretch").orderBy("slot")) - 1
    return (
        drawn.withColumn("inside", inside)
        .join(stored(counts, "op2-ranks"), ["key", "stretch"])
        .select("slot", "key", "blocks", (F.col("before") + F.col("inside")).alias("rank"))
        .where(F.col("rank") < F.col("blocks") * MOST_REPEATS)
        .select("slot", "key", "rank", (F.col("rank") % F.col("blocks")).alias("block"))
    )


def pieces(placed: DataFrame) -> DataFrame:
    """The parts of each document by block of its source; documents without words have none (block -1)."""
    end = F.col("at") + F.col("size")
    block = F.when(F.col("size") > 0, F.sequence(F.expr("at div length"), F.expr("(at + size - 1) div length"))).otherwise(
        F.array(F.lit(-1).cast("long"))
    )
    low, high = F.col("block") * F.col("length"), (F.col("block") + 1) * F.col("length")
    return placed.withColumn("block", F.explode(block)).withColumn(
        "words", F.when(F.col("size") > 0, F.least(end, high) - F.greatest("at", low)).otherwise(F.lit(0)).cast("long")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = 0) -> DataFrame:
    """Of each row of ``docs`` (doc_id, text, source) how many words the mix takes, with its
    source's size and target."""
    sizes = stored(document_sizes(docs), "op2-sizes")
    sources = stored(source_targets(sizes, weights), "op2-targets")
    uses = schedule(sources).groupBy("key", "block").agg(F.count("*").alias("uses"))
    parts = pieces(layout(sizes, sources, seed))
    one = ["key", "bucket", "row", "doc_id", "source", "size", "source_size", "target"]
    return (
        parts.join(uses, ["key", "block"], "left")
        .groupBy(*one)
        .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken", "source")
    )


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The mix itself: (slot, source, doc_id, first, words), the stretch of each document that
    each slot of the schedule takes; ``first`` counts the document's words from 0."""
    sizes = stored(document_sizes(docs), "op2-sizes")
    sources = stored(source_targets(sizes, weights), "op2-targets")
    parts = pieces(layout(sizes, sources, seed)).where("size > 0")
    first = F.greatest(F.lit(0), F.col("block") * F.col("length") - F.col("at"))
    return schedule(sources).join(parts, ["key", "block"]).select("slot", "source", "doc_id", first.alias("first"), "words")
