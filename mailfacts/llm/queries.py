"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailfacts.llm import bpe, contamination, extraction, hmm, mixing, neardup, quality, repetition, spelling, toxicity
from mailfacts.llm.common import SPACED_WORD, table
from mailfacts.llm.license import scan_licenses
from mailfacts.llm.pii import find_personal_data
from mailfacts.llm.repetition import repetition_coverage
from mailfacts.llm.runs import periodic_runs

Query = Callable[[SparkSession, str], DataFrame]


def op1_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, labels))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents")).drop("found")


def op7_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("places")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_quality(docs, quality.train(docs, labels))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.find_contamination(docs, benchmark)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition_coverage(table(spark, sf_dir, "documents"))
    return found.drop("ngram_shares", "line_share")


def _made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, all words from some word on repeat the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)))
    )
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    bounds = picked.withColumns({"n": n, "g": g}).withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))

    def repeated(word: Column, i: Column) -> Column:
        again = F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        return F.when(i >= F.col("a"), again).otherwise(word)

    text = F.when(F.col("n") > 0, F.array_join(F.transform("words", repeated), " ")).otherwise(F.col("text"))
    return bounds.withColumn("p", period).select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_made_periodic(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    # Runs come by start and period, so the first of equal exponents stays.
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.words_with_typos(table(spark, sf_dir, "documents"), rate=31)
    return spelling.spelling_variants(words)


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = bpe.Vocabulary.read(path, public_tokenizers.PATTERN)
    ids = F.col("ids")
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(bpe.packed(ids, vocabulary), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(ids, vocabulary), 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Query]:
    named = (
        op1_hidden_markov, op2_source_mix, op3_main_text, op4_toxicity, op5_near_duplicates,
        op6_personal_data, op7_license_templates, op8_quality_rules, op9_decontamination, op10_repetition,
        op11_periodic_runs, op12_spelling_variants, op13_byte_pairs,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_near_duplicates": neardup.SQL,
        "op9_decontamination": contamination.SQL,
        "op10_repetition": repetition.sql(),
    }
